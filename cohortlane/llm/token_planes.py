"""Token ids in a binary format of transposed planes.

Texts are dealt into ranges of ``doc_id`` and encoded in order. Each range is cut into chunks of a fixed number of ids;
a chunk's 32-bit ids are transposed into 32 bit planes or 4 byte planes, and every plane is compressed by itself with
zstandard, so the high planes, mostly zero, cost next to nothing. A folder holds ``chunks`` (the planes, with the slices
of documents inside each chunk) and ``index`` (for each chunk its first id in the whole order, count and sizes). Both are
written by Spark, so a lost executor costs only its tasks.

A null text is empty and yields only the end id. Rows without id come first; rows that repeat an id follow each other in
text order, each with its own row. An empty table gives an empty folder. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortlane.session import scratch_folder

CHUNK_IDS = 1 << 16
#: Bytes of texts encoded at a time; a longer text is encoded alone.
TOGETHER = 6_000_000
CHUNKS = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.binary())),
    ("first_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())),
    ("lengths", pa.list_(pa.int32())),
])
CHUNKS_DDL = (
    "part int, chunk int, n_ids int, planes array<binary>, first_doc long, doc_ids array<long>, "
    "starts array<int>, lengths array<int>"
)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of unsigned 32-bit ids, lowest first."""
    table = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        planes = np.packbits(np.unpackbits(table, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = table.T
    packer = zstandard.ZstdCompressor(level=3)
    return [packer.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    unpacker = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpacker.decompress(p), dtype=np.uint8) for p in planes]
    if len(rows) == 32:
        bits = np.stack([np.unpackbits(r, bitorder="little")[:n] for r in rows], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()


@cache
def load_tokenizer(path: str):
    # Spark has a task on every core; the tokenizer's own threads would each hold memory of their own
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: A worker keeps the ids of at most so many parts of words that it has met, and encodes so many new ones in one text.
MOST_KEPT, IN_ONE = 600_000, 64
#: Words parted, and new parts encoded, at a time: they take many times their length meanwhile.
AT_ONCE = 16_384
#: Words in which the tokenizer's own rules for parts are not plain: with any character but printable ASCII and letters that
#: are one code point in every normal form and have one other case. Such words are left to the tokenizer whole.
ODD = re.compile("[^ -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FE]")
#: The pattern by which the tokenizer parts all other words, once they are in lower case; a blank ends a word.
LETTERS = "a-z\u00DF-\u00F6\u00F8-\u00FE"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^ 0-9{LETTERS}]+| ")


class Parts:
    """Ids of parts of words, end to end, with the place of each part."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1 + len(added), dtype=bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.starts, self.lengths = (np.zeros(0, dtype=t) for t in (np.uint32, np.int64, np.int64))

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, end to end, and how many each has."""
        found = [self._encoded(parts[i : i + AT_ONCE]) for i in range(0, len(parts), AT_ONCE)] or [self._encoded([])]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([lengths for _, lengths in found])

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = [" ".join(parts[i : i + IN_ONE]) for i in range(0, len(parts), IN_ONE)]
        ids = np.array([i for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids], dtype=np.uint32)
        ends = np.flatnonzero(self.last[np.minimum(ids, len(self.last) - 1)])
        if len(ends) == len(parts) and (not len(ids) or ends[-1] == len(ids) - 1):
            return ids, np.diff(ends, prepend=-1)
        # the ends of words don't tell the parts: encode each by itself
        found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], dtype=np.uint32), np.array([len(x) for x in found], dtype=np.int64)

    def places(self, distinct: list[str], odd: set[str]) -> np.ndarray:
        """Where each part's ids are; ``odd`` parts are encoded by themselves."""
        if len(self.slots) > MOST_KEPT:
            self.clear()
        fresh = [w for w in distinct if w not in self.slots]
        if fresh:
            whole = [w for w in fresh if w in odd] if odd else []
            fresh = [w for w in fresh if w not in odd] if whole else fresh
            ids, lengths = self.encoded(fresh)
            found = [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            ids = np.concatenate([ids, np.array([i for x in found for i in x], dtype=np.uint32)])
            lengths = np.concatenate([lengths, np.array([len(x) for x in found], dtype=np.int64)])
            self.slots.update(zip(fresh + whole, range(len(self.slots), len(self.slots) + len(lengths))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, ids])
        return np.fromiter(map(self.slots.__getitem__, distinct), dtype=np.int64, count=len(distinct))

    def parts_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the parts of all words, end to end, and how many parts each word has."""
        low_parts, odd, which, alone = [], set(), [], []
        for at in range(0, len(words), AT_ONCE):
            names = words.slice(at, AT_ONCE).to_pylist()
            text = " ".join(names)
            low = text.lower()
            if ODD.search(text) or (self.added and self.added.search(low)):
                left = [i for i, w in enumerate(names) if ODD.search(w) or (self.added and self.added.search(w.lower()))]
                for i in left:
                    which.append(at + i)
                    alone.append(names[i])
                    names[i] = ""
                low = " ".join(names).lower()
            low_parts.append(pa.array([" ", *PARTS.findall(low)], type=pa.string()))
        odd.update(alone)
        # a blank ends each word; its own place, the first one, is not used
        found = pa.chunked_array([*low_parts, pa.array([" "])]).dictionary_encode()
        codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in found.chunks])
        counts = np.diff(np.flatnonzero(codes == 0)) - 1
        distinct, codes = found.chunk(0).dictionary.to_pylist()[1:], codes[codes > 0] - 1
        if odd:
            alone = pa.array(alone).dictionary_encode()
            codes = np.insert(codes, np.cumsum(counts)[which], alone.indices.to_numpy(zero_copy_only=False) + len(distinct))
            distinct, counts[which] = distinct + alone.dictionary.to_pylist(), 1
        return self.places(distinct, odd)[codes], counts


@cache
def known_parts(path: str) -> Parts:
    return Parts(path)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def encode(texts: list[str | None] | pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each with the end id, and the end of each text.

    The tokenizer never joins across white space, nor across the parts of a word. So each distinct word is parted once
    for many texts, and each distinct part is encoded once for many words.
    """
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, type=pa.string())
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten().dictionary_encode()
    codes, bounds = words.indices.to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    kept = known_parts(path)
    places, counts = kept.parts_of(words.dictionary) if len(words.dictionary) else (np.zeros(0, dtype=np.int64),) * 2
    lengths = kept.lengths[places]
    flat = kept.flat[spread(kept.starts[places], lengths)]  # the ids of all distinct words
    upto = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
    each = np.diff(upto)[codes]
    text_ends = np.concatenate([[0], np.cumsum(each)])[bounds[1:]].astype(np.int64)
    ids = np.insert(flat[spread(upto[codes], each)], text_ends, end_id)
    return ids, text_ends + np.arange(1, len(texts) + 1)


def bounded(texts: pa.Array) -> list[tuple[int, int]]:
    """Bounds of slices that begin within ``TOGETHER`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // TOGETHER, prepend=-1)).tolist()
    return list(zip(at, [*at[1:], len(texts)]))


def _chunks(path: str, end_id: int, size: int, kind: str):
    def run(batches):
        part = TaskContext.get().partitionId()
        number, first, held = 0, 0, np.zeros(0, dtype=np.uint32)
        docs: list[list] = []  # id and number of ids still to write, of the documents in ``held``

        def chunk(n: int):
            nonlocal number, first, held, docs
            names, starts, lengths, left = [], [], [], n
            for doc in docs:
                take = min(doc[1], left)
                if not take:
                    break
                names.append(doc[0])
                starts.append(n - left)
                lengths.append(take)
                doc[1] -= take
                left -= take
            row = [part, number, n, to_planes(held[:n], kind), first, names, starts, lengths]
            ended = sum(1 for d in docs[: len(names)] if not d[1])
            docs, first, number, held = docs[ended:], first + ended, number + 1, held[n:]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, CHUNKS)], schema=CHUNKS)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at, upto in bounded(texts):
                ids, ends = encode(texts.slice(at, upto - at), path, end_id)
                docs += [[d, int(n)] for d, n in zip(names[at:upto], np.diff(ends, prepend=0))]
                held = np.concatenate([held, ids])
                pa.default_memory_pool().release_unused()
                while len(held) >= size:
                    yield chunk(size)
        if len(held):
            yield chunk(len(held))

    return run


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, size: int = CHUNK_IDS, kind: str = "byte",
) -> None:
    """Encode ``docs(doc_id, text)`` and write the folder ``path``."""
    spark = docs.sparkSession
    ranged = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(_chunks(tokenizer, end_id, size, kind), CHUNKS_DDL).write.parquet(f"{path}/chunks")
    chunks = spark.read.schema(CHUNKS_DDL).parquet(f"{path}/chunks").select(
        "part", "chunk", "n_ids", F.transform("planes", F.octet_length).alias("plane_bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    chunks.join(parts, "part").select(
        "part", "chunk", (F.col("first") + F.col("chunk").cast("long") * size).alias("first_id"), "n_ids", "plane_bytes",
    ).write.parquet(f"{path}/index")


SLICES = "part int, chunk int, doc long, doc_id long, start int, n int, crc long, ids binary"


def _slices(with_ids: bool):
    def run(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, found = from_planes(list(row.planes), row.n_ids), []
                for i, (name, start, n) in enumerate(zip(row.doc_ids, row.starts, row.lengths)):
                    content = ids[start : start + n].tobytes()
                    found.append((row.part, row.chunk, row.first_doc + i, name, start, n, zlib.crc32(content),
                                  content if with_ids else None))
                frame = pd.DataFrame(found, columns=[c.split()[0] for c in SLICES.split(", ")])
                yield frame.astype({"doc_id": "Int64"})

    return run


def read_slices(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document and chunk, with the slice's place in the whole order as ``at``."""
    # few chunks a batch: a chunk is some hundred kilobytes once it is unpacked
    chunks = spark.read.schema(CHUNKS_DDL).parquet(f"{path}/chunks")
    index = spark.read.parquet(f"{path}/index").filter("chunk = 0").select("part", F.col("first_id").alias("first"))
    size = F.col("chunk").cast("long")
    found = chunks.mapInPandas(_slices(with_ids), SLICES).join(index, "part")
    full = spark.read.parquet(f"{path}/index").agg(F.max("n_ids")).first()[0] or 1
    return found.select("part", "chunk", "doc", "doc_id", (F.col("first") + size * full + F.col("start")).alias("at"),
                        "n", "crc", "ids")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)``: each document's ids as binary little-endian unsigned 32-bit integers."""
    slices = read_slices(spark, path, with_ids=True)
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "ids")))
    return slices.groupBy("part", "doc", "doc_id").agg(F.min("at").alias("start"), ordered.alias("s")).select(
        "doc_id", "start", F.expr("aggregate(s.ids, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"))


POLYNOMIAL = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32


def _product(a: int, b: int) -> int:
    total = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            total ^= b
        b = (b >> 1) ^ (POLYNOMIAL if b & 1 else 0)
    return total


def crc_joined(slices: list[tuple[int, int]]) -> int:
    """CRC-32 of slices end to end, from (bytes, crc) of each."""
    total = 0
    for n, crc in slices:
        power, square, left = 1 << 31, 1 << 23, n  # the polynomials 1 and x^8
        while left:
            if left & 1:
                power = _product(power, square)
            square = _product(square, square)
            left >>= 1
        total = _product(power, total) ^ crc
    return total


def _joined(slices: pd.Series) -> pd.Series:
    return slices.map(lambda s: s[0]["crc"] if len(s) == 1 else crc_joined([(4 * x["n"], x["crc"]) for x in s]))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` read from a folder."""
    slices = read_slices(spark, path)
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "n", "crc")))
    found = slices.groupBy("part", "doc", "doc_id").agg(
        F.min("at").alias("start"), F.sum("n").alias("n_tokens"), ordered.alias("slices"))
    return found.select("doc_id", "start", "n_tokens", F.pandas_udf(_joined, "long")("slices").alias("ids_crc32"))


def stored(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents below the shared scratch folder and read their digests back."""
    path = f"{scratch_folder(docs.sparkSession)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer)
    return document_digests(docs.sparkSession, path)
