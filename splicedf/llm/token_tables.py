"""Token-ID output: whole texts to ids, written by Spark as sorted tables in key order, and read back."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splicedf.llm import sorted_tables
from splicedf.llm.common import maybe_broadcast, written

#: Bytes of text in a file, by mean.
FILE_BYTES = 16 << 20
#: Words that a Python worker remembers the ids of.
WORDS_KEPT = 1_500_000
#: White space beside white space, and white space other than space and line feed: texts with these go whole.
BESIDE = ("  ", "\n\n", " \n", "\n ")
OTHER_SPACE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_coders: dict[str, Coder] = {}


class Coder(dict):
    """A byte-level tokenizer that remembers words.

    Its pre-tokenizer always cuts before a single space, and before and after a single line feed, if no white space is
    beside them; what lies between can be encoded on its own. Other texts, and those that hold an added token, go to the
    tokenizer whole. A key is a word that
    follows a space, or a line feed and the word that follows it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.added = tuple(x.content for x in self.whole.get_added_tokens_decoder().values())
        self.model = self.whole.model
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        steps = self.whole.pre_tokenizer
        plain = self.whole.normalizer is None and self.whole.post_processor is None and type(steps).__name__ == "ByteLevel" and not steps.add_prefix_space
        self.steps = steps if plain else None
        self.feed = self.coded("\n") if plain else b""

    def coded(self, text: str) -> bytes:
        ids = [t.id for piece, _ in self.steps.pre_tokenize_str(text) for t in self.model.tokenize(piece)]
        return np.array(ids, self.dtype).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        if word.isascii() and word.isalpha():  # one piece of letters, which stand for themselves; \u0120 is the space
            out = np.array([t.id for t in self.model.tokenize("\u0120" + word)], self.dtype).tobytes()
        else:
            out = self.coded(word if word[0] == "\n" else " " + word)
        self[word] = out
        return out

    def encoded(self, text: str) -> bytes:
        if not text:
            return b""
        if self.steps is None or text[0].isspace() or text[-1].isspace() or any(x in text for x in BESIDE) or any(c in text for c in OTHER_SPACE) or any(a in text for a in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        first, *words = text.replace("\n", " \n").split(" ")
        return self["\n" + first][len(self.feed) :] + b"".join(map(self.__getitem__, words))


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def file_pieces(path: str, end_id: int):
    """mapInArrow: a partition's (_id, text) in key order to the pieces of its file."""

    def run(batches):
        c = coder(path)
        end = np.array([end_id], c.dtype).tobytes()

        def rows() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield i, c.encoded(text or "") + end

        for piece in sorted_tables.chunks(rows(), c.width):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], ["value"])

    return run


def write_tables(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One file a range of ids, in ascending order of ids, at `path`, through Spark's own writer and commit.

    Null text counts as empty; null ids come first; equal ids stay together in the order of their texts' hashes, and a
    repeated row is an entry of its own. An empty table writes no entries.
    """
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("text")]
    d = d.repartitionByRange(max(1, math.ceil(total / FILE_BYTES)), *order).sortWithinPartitions(*order)
    d.mapInArrow(file_pieces(tokenizer, end_id), "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)


def entries(batches):
    """mapInArrow: (path, content) of files to a row for each of their entries."""
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not data:
                continue
            table, at, rows = sorted_tables.Table(data), 0, []
            for i, (key, raw) in enumerate(table):
                ids = table.ids(raw)
                rows.append((path, i, sorted_tables.id_of(key), at, len(ids), sorted_tables.crc_of(ids)))
                at += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), *[pa.int64()] * 5))], ["path", "at", "_id", "_start", "n_tokens", "ids_crc32"])


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """(_id, start, n_tokens, ids_crc32, file) of every entry, from the files. start counts the ids of all before it.

    A file numbers its own ids; the files' totals, a row each, are summed up in file order and joined back.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = files.mapInArrow(entries, "path string, at long, _id long, _start long, n_tokens long, ids_crc32 long")
    rows = written(rows.withColumn("file", F.regexp_extract("path", r"part-(\d+)", 1).cast("int")).drop("path"), "entries")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return rows.join(maybe_broadcast(totals), "file").select("_id", (F.col("_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32", "file")


def found_in(path_of_files: DataFrame, ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a list of ids, by each file's filter and binary search; files: (path, content)."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                if data:
                    table = sorted_tables.Table(data)
                    got = [(i, x.tolist()) for i in ids for x in table.find(i)]
                    yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return path_of_files.select("content").mapInArrow(run, "doc_id long, ids array<long>")
