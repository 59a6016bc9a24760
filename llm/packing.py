"""Packing by lexical retrieval: sharded BM25 indexes fill windows with neighbours (operator 11).

Documents become token ids once. What fills whole windows of its own leaves a document at
once; its rest, always shorter than a window, is packed with the rests of others. Rests
are dealt to shards by a rare token that they share, so that a shard holds documents of one
subject, and a shard is bounded in documents and therefore in tokens. In a shard an
inverted index with BM25 weights answers each seed document with the unused documents that
are lexically nearest, and these fill the seed's window in order. A document that reaches
over the end of a window is cut there, and what is left of it is the next seed. The tokens
behind the last full window of a shard are cut into lengths that are powers of two, which
need no padding.

The terms of the index are the tokens; their weights come from all documents. There are as
many as the vocabulary has, so their counts are small whatever the corpus.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from llm.common import as_bytes, freed, mix, slices, table, with_small
from skuweave.session import cut_lineage, new_folder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Fixed value: the id behind every document.
END = 2
WINDOW = 4096
#: Documents of a shard: what hashing aims at, and where a shard is split.
SHARD, MOST = 2_000, 3_000
#: Constants of BM25: saturation of a token's count, and the weight of a text's length.
K1, B = 1.2, 0.75
_CACHED = 600_000
#: Marks without those of contractions and of the vocabulary's special tokens.
_MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_LOCAL = 12  # bits of a sequence's number within its shard

#: How merges name the bytes of letters from U+0080 to U+00FF that are no visible characters themselves.
_NAMES = {byte: 256 + at for at, byte in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}


class Encoder:
    """Ids of texts as the tokenizers library gives them, each distinct word encoded once.

    The vocabulary's splitter drops white space and never reads over it, so the ids of a
    text are those of the words between white space, one behind another. Two generations
    of known words bound the memory. Words of the letters a to z go to the vocabulary's
    merges directly: lower case is all that would happen to them before; so do words of
    letters up to U+00FF, byte by byte.
    """

    def __init__(self, vocabulary: str):
        self.library = Tokenizer.from_str(vocabulary)
        pieces = self.library.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(pieces.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(pieces.values()) + 1, bool)
        self.ends[[at for piece, at in pieces.items() if piece.endswith(("</w>", "|>"))]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}

    def texts(self, texts: Sequence[bytes]) -> list[bytes]:
        """Ids of each text; the new words of all are learned together."""
        split = [text.split() for text in texts]
        if len(self.young) > _CACHED:
            self.old, self.young, self.marks = self.young, {}, {}
        self.learn(set().union(*split).difference(self.young))
        known = self.young.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def learn(self, words: set[bytes]) -> None:
        """Bring the words into the young generation."""
        young, old = self.young, self.old
        ask: set[bytes] = set()
        marked = []
        for word in words:
            if word in old:
                young[word] = old[word]
                continue
            # Letters are one piece, and the marks behind them are another.
            stem = word if word.isalpha() else word.rstrip(_MARKS)
            if not (stem.isalpha() or not stem.isascii() and stem.decode("utf-8", "replace").isalpha()):
                young[word] = self.alone(word.decode("utf-8", "replace"))
            elif len(stem) == len(word):
                ask.add(word)
            else:
                marked.append((word, stem))
        ask.update([stem for _, stem in marked if stem not in young and stem not in old])
        merge, code, stems = self.library.model.tokenize, self.kind.char, []
        for stem in ask:
            if stem.isascii():
                young[stem] = array(code, [piece.id for piece in merge(stem.lower().decode())]).tobytes()
                continue
            text = stem.decode("utf-8", "replace")
            if max(text) <= "\xff":
                # Composed letters, whose lower case is one letter; merges name their bytes by characters.
                named = text.lower().encode().decode("latin-1").translate(_NAMES)
                young[stem] = array(code, [piece.id for piece in merge(named)]).tobytes()
            else:
                stems.append(stem)
        young.update(zip(stems, self.pieces(stems)))
        for word, stem in marked:
            young[word] = (young[stem] if stem in young else old[stem]) + self.run(word[len(stem) :])

    def run(self, marks: bytes) -> bytes:
        """Ids of marks behind letters, each run of marks encoded once."""
        if marks not in self.marks:
            self.marks[marks] = self.alone(marks.decode())
        return self.marks[marks]

    def alone(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def pieces(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, many in one text: each ends where a piece ends a word."""
        found: list[bytes] = []
        for at in range(0, len(words), 1_000):
            some = words[at : at + 1_000]
            text = b" ".join(some).decode("utf-8", "replace")
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                # Lower case makes marks of a few letters, which are pieces of their own.
                found += [self.alone(word.decode("utf-8", "replace")) for word in some]
                continue
            data, size = ids.astype(self.kind).tobytes(), self.kind.itemsize
            cuts = [0, *(stops * size).tolist()]
            found += [data[start:stop] for start, stop in zip(cuts, cuts[1:])]
        return found


@lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(df: DataFrame, vocabulary: Broadcast, id_col: str, text_col: str, window: int, end: int) -> DataFrame:
    """(row, part, id, tokens, first_head, heads, rest): every document once, written.

    ``heads`` holds the checksums of the windows that the document fills alone,
    ``first_head`` how many such windows its partition had before, ``rest`` the ids left.
    """
    kind = df.schema[id_col].dataType
    ids_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        part = TaskContext.get().partitionId()
        last = np.array([end], encoder.kind).tobytes()
        seen = {"rows": 0, "heads": 0}

        def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
            tokens, firsts, heads, rests = [], [], [], []
            for found in encoder.texts(batch.column(1).to_numpy(zero_copy_only=False)):
                ids = np.frombuffer(found + last, encoder.kind)
                whole = len(ids) // window
                tokens.append(len(ids))
                firsts.append(seen["heads"])
                heads.append([crc32(ids[at * window : (at + 1) * window]) for at in range(whole)])
                rests.append(ids[whole * window :].tobytes())
                seen["heads"] += whole
            rows = np.arange(seen["rows"], seen["rows"] + batch.num_rows) + (part << 33)
            seen["rows"] += batch.num_rows
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    batch.column(0).cast(ids_type),
                    pa.array(tokens, pa.int64()),
                    pa.array(firsts, pa.int64()),
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(rests, pa.binary()),
                ],
                names=["row", "part", "id", "tokens", "first_head", "heads", "rest"],
            )

        for batch in batches:
            yield from slices(batch, encode)

    schema = f"row long, part int, id {kind.simpleString()}, tokens long, first_head long, heads array<long>, rest binary"
    path = new_folder(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).mapInArrow(freed(run), schema)
    rows.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def _split(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of binary rests without their end ids, and each one's number of ids."""
    rests = [np.frombuffer(rest, kind)[:-1] for rest in column.to_pylist()]
    return np.concatenate([*rests, np.zeros(0, kind)]), np.array([len(rest) for rest in rests], np.int64)


def distinct_tokens(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, count): an entry for each token of each document, in order."""
    shift = np.uint64(32)
    keys = np.sort(np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths) << shift | ids)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    found = keys[first]
    token = (found & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return (found >> shift).astype(np.int64), token, np.diff(first, append=len(keys))


def document_counts(rests: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(token, n): in how many rests each token is; a task sums up before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        total = np.zeros(len(encoder.ends), np.int64)
        for batch in batches:
            for part in slices(batch, lambda part: part):
                _, token, _ = distinct_tokens(*_split(part.column(0), encoder.kind))
                total += np.bincount(token, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["token", "n"])

    return rests.select("rest").mapInArrow(freed(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Weights:
    """Inverse document frequencies of the vocabulary's tokens; 0 for a token that half of
    the documents have."""

    def __init__(self, counts: np.ndarray, documents: int, mean_ids: float):
        self.idf = np.maximum(0, np.log((documents - counts + 0.5) / (counts + 0.5))).astype(np.float32)
        self.mean_ids = max(mean_ids, 1.0)
        # A token's place in the draw of routes: the rarer it is, the likelier it comes first.
        draw = ((mix(np.arange(len(counts), dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
        self.late = np.where(self.idf > 0, -np.log(draw) / np.maximum(self.idf, 1e-3) ** 4, np.inf)


def corpus_weights(rests: DataFrame, vocabulary: Broadcast, documents: int, ids: float) -> Weights:
    """Statistics of all rests; a number for each token of the vocabulary comes to the driver."""
    found = document_counts(rests, vocabulary).toArrow()
    counts = np.zeros(len(_encoder(vocabulary.value).ends), np.int64)
    counts[found.column("token").to_numpy()] = found.column("n").to_numpy()
    return Weights(counts, documents, ids / max(documents, 1))


def routes(ids: np.ndarray, lengths: np.ndarray, weights: Weights) -> np.ndarray:
    """A token of each document, drawn alike in all documents and the rarer the likelier,
    so that documents that share rare tokens draw the same; -1 without one."""
    late = weights.late[ids]
    full = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[full]
    found = np.full(len(lengths), -1, np.int64)
    if len(starts):
        least = np.minimum.reduceat(late, starts)
        first = np.flatnonzero(late == np.repeat(least, lengths[full]))
        owner = np.searchsorted(starts, first, "right") - 1
        chosen = first[np.concatenate([[True], owner[1:] != owner[:-1]])]
        found[full] = np.where(np.isfinite(least), ids[chosen].astype(np.int64), -1)
    return found


def with_buckets(rests: DataFrame, vocabulary: Broadcast, weights: Broadcast, buckets: int) -> DataFrame:
    """``rests`` with the bucket of its route; a rest without one goes by its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)

        def place(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, lengths = _split(batch.column(batch.schema.get_field_index("rest")), encoder.kind)
            route = routes(ids, lengths, weights.value)
            row = batch.column(batch.schema.get_field_index("row")).to_numpy()
            bucket = mix(np.where(route < 0, row, -1 - route).view(np.uint64)) % np.uint64(buckets)
            return batch.append_column("bucket", pa.array(bucket.astype(np.int64)))

        for batch in batches:
            yield from slices(batch, place)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rests.schema.fields)
    return rests.mapInArrow(freed(run), f"{fields}, bucket long")


class Index:
    """An inverted index over the rests of a shard, with BM25 weights.

    Tokens of one document only are left out, since they cannot name a neighbour, and so
    are those without weight. The index forgets used documents whenever half of what it
    holds is used.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, weights: Weights):
        document, token, count = distinct_tokens(ids, lengths)
        shared = (np.bincount(token, minlength=len(weights.idf))[token] > 1) & (weights.idf[token] > 0)
        document, count = document[shared], count[shared]
        known, term = np.unique(token[shared], return_inverse=True)
        self.size = len(lengths)
        self.terms = len(known)
        self.query_terms = term
        self.query_stops = np.searchsorted(document, np.arange(self.size + 1))
        room = K1 * (1 - B + B * lengths / weights.mean_ids)
        weight = (weights.idf[known][term] * count * (K1 + 1) / (count + room[document])).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.documents, self.weights, self.of = document[order], weight[order], term[order]
        self.unused = np.ones(self.size, bool)
        self.left = self.held = self.size
        self._cut()

    def _cut(self) -> None:
        self.stops = np.searchsorted(self.of, np.arange(self.terms + 1))

    def use(self, document: int) -> None:
        self.unused[document] = False
        self.left -= 1
        if 2 * self.left < self.held:
            keep = self.unused[self.documents]
            self.documents, self.weights, self.of = self.documents[keep], self.weights[keep], self.of[keep]
            self.held = self.left
            self._cut()

    def neighbours(self, seed: int) -> np.ndarray:
        """All unused documents that share a token with the seed, the nearest first."""
        asked = self.query_terms[self.query_stops[seed] : self.query_stops[seed + 1]]
        first, sizes = self.stops[asked], self.stops[asked + 1] - self.stops[asked]
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        scores = np.bincount(self.documents[at], self.weights[at], self.size)
        near = np.flatnonzero((scores > 0) & self.unused)
        return near[np.argsort(-scores[near], kind="stable")]


def fill(lengths: np.ndarray, index: Index, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (sequence, offset, document, start, length) that use up all documents.

    The seed of a window is what is left of the document cut before, else the first unused
    document. Its neighbours follow, nearest first; where they do not fill the window, the
    next unused document is one more seed.
    """
    sequence, offset = 0, 0
    waiting = iter(())
    open_pieces: list[tuple[int, int, int]] = []
    first = 0
    cut = None
    while True:
        if cut is not None:
            document, start = cut
            cut = None
            waiting = iter(index.neighbours(document))
        else:
            document = next((n for n in waiting if index.unused[n]), None)
            if document is None:
                while first < len(lengths) and not index.unused[first]:
                    first += 1
                if first == len(lengths):
                    break
                document = first
                waiting = iter(index.neighbours(document))
            document, start = int(document), 0
            index.use(document)
        length = int(min(lengths[document] - start, window - offset))
        open_pieces.append((document, start, length))
        offset += length
        if offset == window:
            yield from ((sequence, at, *piece) for at, piece in _placed(open_pieces))
            open_pieces, offset, sequence, waiting = [], 0, sequence + 1, iter(())
            if start + length < lengths[document]:
                cut = (document, start + length)
    yield from _powers(open_pieces, offset, sequence)


def _placed(pieces: list[tuple[int, int, int]]) -> Iterator[tuple[int, tuple[int, int, int]]]:
    at = 0
    for piece in pieces:
        yield at, piece
        at += piece[2]


def _powers(pieces: list[tuple[int, int, int]], total: int, sequence: int) -> Iterator[tuple[int, int, int, int, int]]:
    """The last tokens of a shard in sequences whose lengths are powers of two."""
    room, offset = 0, 0
    for document, start, length in pieces:
        while length:
            if offset == room:
                sequence, offset, room = sequence + bool(room), 0, 1 << (total.bit_length() - 1)
                total -= room
            taken = min(length, room - offset)
            yield sequence, offset, document, start, taken
            start, length, offset = start + taken, length - taken, offset + taken


def pack(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end: int = END,
    shard: int = SHARD,
    most: int = MOST,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    Every id of every document, the end id behind it included, is in exactly one piece;
    only lengths that are powers of two are below ``window``. A null or empty text is its
    end id alone. Repeated rows and equal or null ids are documents of their own. An empty
    table gives no rows; other columns are not read. A text of any length is encoded
    whole. Equally near neighbours come in the order of the shard's rows.
    """
    spark = df.sparkSession
    # The split of a full bucket by row is uneven; twice its mean is far beyond what occurs.
    if window & (window - 1) or max(2 * shard, most) + window.bit_length() > 1 << _LOCAL:
        raise ValueError(f"the window must be a power of two, and a shard must have less than {1 << _LOCAL} sequences")
    with open(vocabulary, encoding="utf-8") as file:
        words = spark.sparkContext.broadcast(file.read())
    rows = encoded(df, words, id_col, text_col, window, end)
    kind = rows.schema["id"].dataType
    # Totals, and numbers of the windows that documents fill alone: one row per partition.
    size = F.length("rest") / F.lit(np.dtype(_encoder(words.value).kind).itemsize)
    parts = (
        rows.groupBy("part")
        .agg(F.sum(F.size("heads")).alias("n"), F.sum((size > 0).cast("long")).alias("rests"), F.sum(size).alias("ids"))
        .orderBy("part")
        .collect()
    )
    documents, ids = sum(part["rests"] for part in parts), sum(part["ids"] for part in parts)
    reached, base = 0, []
    for part in parts:
        base.append((part["part"], reached))
        reached += part["n"]
    bases = spark.createDataFrame(base, "part int, base long")
    heads = rows.filter(F.size("heads") > 0).join(with_small(bases, len(base)), "part").select(
        "id", "tokens", (F.col("base") + F.col("first_head")).alias("base"), F.posexplode("heads").alias("at", "ids_crc32")
    )
    heads = heads.select(
        F.col("id").alias(id_col),
        (F.col("at").cast("long") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        F.col("tokens").alias("doc_tokens"),
        (F.col("base") + F.col("at")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rests = rows.filter(F.length("rest") > 0).select("row", "id", "tokens", "rest")
    weights = corpus_weights(rests, words, documents, ids)
    buckets = max(1, -(-documents // shard))
    if buckets >= 1 << 26:
        raise ValueError("more than 2**26 shards: raise shard")
    shared = spark.sparkContext.broadcast(weights)
    placed = with_buckets(rests, words, shared, buckets)
    path = new_folder(spark)
    placed.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    full = cut_lineage(
        placed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > most)
        .select("bucket", F.ceil(F.col("rows") / shard).alias("salts"))
    )
    # A bucket that copies or a common subject have filled is split by row.
    salt = F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1)))
    placed = placed.join(with_small(full, full.count()), "bucket", "left").withColumn("salt", salt).drop("salts")
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids_type = to_arrow_type(kind)
    types = [ids_type, *[pa.int64()] * 6]

    def packed(group: pa.Table) -> pa.Table:
        encoder = _encoder(words.value)
        group = group.sort_by("row")
        bucket, salt = group.column("bucket")[0].as_py(), group.column("salt")[0].as_py()
        rests = [np.frombuffer(rest, encoder.kind) for rest in group.column("rest").to_pylist()]
        lengths = np.array([len(rest) for rest in rests], np.int64)
        index = Index(np.concatenate([rest[:-1] for rest in rests]), lengths - 1, shared.value)
        pieces = list(fill(lengths, index, window))
        sequence, offset, document, start, length = np.array(pieces, np.int64).T
        tokens = group.column("tokens").to_numpy()[document]
        found = [
            group.column("id").combine_chunks().cast(ids_type).take(pa.array(document)),
            tokens - lengths[document] + start,
            length,
            np.array([crc32(rests[d][s : s + n]) for _, _, d, s, n in pieces], np.int64),
            tokens,
            reached + ((((salt << 26) + bucket) << _LOCAL) + sequence),
            offset,
        ]
        return pa.table([pa.array(column, kind) for column, kind in zip(found, types)], names=names)

    schema = f"`{id_col}` {kind.simpleString()}, " + ", ".join(f"`{name}` long" for name in names[1:])
    return heads.select(*names).unionByName(placed.groupBy("bucket", "salt").applyInArrow(packed, schema))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
