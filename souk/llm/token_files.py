"""Token ids of a corpus as binary files: one id array a file, and document boundaries in Elias-Fano code.

Documents are dealt to tasks by ranges of their id and written in id order. A file is an Elias-Fano code
of the documents' ends, one of their ids, and the ids of all tokens end to end in two or four bytes each. A file has at most
``FILE_TOKENS`` tokens, or one document. A table of the files with their number of tokens gives each file's first token; the position of any document is
then two selects away.

Words between ASCII white space are encoded by the tokenizer library, each distinct word of a task once: the tokenizer's
pattern never matches white space and normalisation does not reach across it, so the ids of a text are those of its words.
"""

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.llm.arrays import pieces
from souk.llm.elias_fano import EliasFano, encode
from souk.llm.tokens import byte_symbols
from souk.session import fresh_dir, materialize

#: Tokens of a file, but for a longer document.
FILE_TOKENS = 1 << 22
#: Words and bytes of words whose ids a Python worker keeps, and words that go to the library at once.
KEPT_WORDS, KEPT_BYTES, SENT_WORDS = 600_000, 1 << 25, 1 << 14
#: Files whose tokens are added up in one group before the groups are.
GROUP = 4096

_MAGIC = b"SOUKTOK1"
_HEAD = struct.Struct("<8sIIQQq")  # magic, bytes of a token, documents without an id, documents, tokens, least id
FILES = "file long, path string, n_docs long, n_tokens long"


# The steps in front of the merges of a lower-casing byte-level BPE with word ends.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Words that these steps only put into lower case, and part from a last mark: letters of Latin-1 that have one lower case.
SIMPLE = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+[.,;:!?]?")
#: Simple words of one text that goes to the library.
JOINED = 256


class Encoder:
    """Packed token ids of texts, with the ids of words seen before kept up to a bound.

    The library's merges are most of its work for words of letters, its normalisation and splitting for the others. Simple words go
    as many at once to its merges alone, if the tokenizer is of the kind they are simple for; all others through every step.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(tokenizer)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kept: dict[bytes, bytes] = {}
        self.kept_bytes = 0
        with open(tokenizer, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", ())]
        splits = [p.get("pattern") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", ())]
        self.merges = None
        if steps == NORMALIZERS and splits == [{"Regex": PATTERN}, None] and spec["model"].get("end_of_word_suffix") == WORD_END:
            self.merges = Tokenizer(self.library.model)
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends = np.zeros(self.library.get_vocab_size(), bool)
            self.ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(WORD_END)]] = True
            shown = byte_symbols()
            self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x21, 0x100)} | {32: " "}

    def _simple(self, words: list[str]) -> list[bytes]:
        parted = [w if w[-1].isalpha() else f"{w[:-1]} {w[-1]}" for w in words]
        parted = [p.lower() if p.isascii() else p.lower().translate(self.shown) for p in parted]
        joined = [" ".join(parted[k : k + JOINED]) for k in range(0, len(parted), JOINED)]
        ids = np.concatenate([np.array(t.ids, f"<u{self.width}") for t in self.merges.encode_batch_fast(joined, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1  # of words and of marks
        last = np.cumsum([1 + (" " in p) for p in parted]) - 1
        if len(stops) != last[-1] + 1:
            raise ValueError("the tokenizer does not end every word")
        bounds = [0, *(stops[last] * self.width).tolist()]
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _any(self, words: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(t.ids, f"<u{self.width}").tobytes() for t in found]

    def _keep(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        fits = [self.merges is not None and SIMPLE.fullmatch(t) is not None for t in texts]
        for which, encode_words in ((True, self._simple), (False, self._any)):
            some = [k for k, fit in enumerate(fits) if fit == which]
            packed = encode_words([texts[k] for k in some]) if some else []
            self.kept.update(zip((words[k] for k in some), packed, strict=True))
            self.kept_bytes += sum(map(len, packed))
        self.kept_bytes += sum(map(len, words))

    def texts(self, texts: list[bytes]) -> list[bytes]:
        split = [text.split() for text in texts]
        if len(self.kept) > KEPT_WORDS or self.kept_bytes > KEPT_BYTES:
            self.kept, self.kept_bytes = {}, 0
        seen: set[bytes] = set()
        seen.update(*split)
        new = list(seen.difference(self.kept))
        for first in range(0, len(new), SENT_WORDS):
            self._keep(new[first : first + SENT_WORDS])
        find = self.kept.__getitem__
        return [b"".join(map(find, words)) for words in split]


@functools.lru_cache(maxsize=1)
def encoder_of(tokenizer: str) -> Encoder:
    """The encoder of a Python worker, with its words, for all tasks that the worker runs."""
    return Encoder(tokenizer)


def file_bytes(doc_ids: list[int | None], tokens: list[bytes], width: int) -> bytes:
    """One file: documents without an id first, the others in ascending order of their id."""
    known = np.array([i for i in doc_ids if i is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(t) // width for t in tokens], dtype=np.int64)
    head = _HEAD.pack(_MAGIC, width, len(doc_ids) - len(known), len(doc_ids), int(ends[-1]) if len(ends) else 0, least)
    codes = encode(ends) + encode(known - least)
    return b"".join([head, codes, b"\0" * (-(len(head) + len(codes)) % 8), *tokens])


class TokenFile:
    """A file's documents, from its bytes or a memory map of it."""

    def __init__(self, data):
        data = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, memoryview)) else data
        magic, width, self.nameless, self.n_docs, self.n_tokens, self.least = _HEAD.unpack(data[: _HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError("not a file of token ids")
        self.ends = EliasFano(data, _HEAD.size)
        self.ids = EliasFano(data, self.ends.stop)
        self.tokens = data[self.ids.stop + -self.ids.stop % 8 :].view(f"<u{width}")

    @classmethod
    def open(cls, path: str) -> "TokenFile":
        """The file mapped into memory: a document then costs two selects and its own tokens."""
        return cls(np.memmap(path, np.uint8, "r"))

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nameless else self.ids[i - self.nameless] + self.least

    def document(self, i: int) -> np.ndarray:
        return self.tokens[self.ends[i - 1] if i else 0 : self.ends[i]]

    def holding(self, token: int) -> int:
        """The document that the token at a position of the array belongs to."""
        return self.ends.up_to(token)


def _file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the tokens of all texts in ascending order of id to files of ``folder``; gives back the table of the files.

    A null text is empty and has the end id alone; rows without an id come first, rows of one id in the order of a
    hash of their text, and every repeated row is written. An empty table gives no files. Ids are whole numbers. A task writes
    under a name of its own and then renames, so a task that runs again leaves the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, made = encoder_of(tokenizer), TaskContext.get(), 0
        system, base = _file_system(folder)
        end = b"" if end_id is None else np.array([end_id], f"<u{encoder.width}").tobytes()
        ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, tokens, held, made
            # files of a task follow those of the task before: tasks are ranges of ids in order
            number, name = (task.partitionId() << 24) + made, f"{task.partitionId():08d}-{made:08d}"
            content = file_bytes(ids, tokens, encoder.width)
            system.create_dir(base, recursive=True)
            with system.open_output_stream(f"{base}/.{name}-{task.taskAttemptId()}") as out:
                out.write(content)
            system.move(f"{base}/.{name}-{task.taskAttemptId()}", f"{base}/{name}.tokens")
            row = [[number], [f"{name}.tokens"], [len(ids)], [held]]
            ids, tokens, held, made = [], [], 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array(v) for v in row], ["file", "path", "n_docs", "n_tokens"])

        for batch in pieces(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            for doc_id, packed in zip(batch.column(0).to_pylist(), encoder.texts(texts), strict=True):
                n = (len(packed) + len(end)) // encoder.width
                if ids and held + n > FILE_TOKENS:
                    yield flush()
                ids.append(doc_id)
                tokens.append(packed + end)
                held += n
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the row's number tells apart the copies of a row, which may be a third of all
    keys = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("copy")]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    return materialize(ordered.mapInArrow(run, FILES), "token-file-table")


def first_tokens(files: DataFrame) -> DataFrame:
    """``(file, first)``: the number of tokens in all files before; summed in groups of files, then over the groups."""
    numbered = files.select("file", "n_tokens", F.expr(f"file div {GROUP << 24}").alias("part"))
    sums = numbered.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    within = numbered.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(parts, "part").select("file", (F.col("base") + F.col("inside")).alias("first"))


def read(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files: the tokens before it, its own, and the
    crc32 of its ids as little-endian 32-bit numbers."""
    columns = ["file", "doc_id", "offset", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                found = TokenFile(memoryview(content.as_buffer()))
                task, made = path.as_py().rpartition("/")[2].removesuffix(".tokens").split("-")
                ends = found.ends.all()
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                wide = found.tokens.astype("<u4").view(np.uint8)
                crcs = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                ids = [None] * found.nameless + (found.ids.all() + found.least).tolist()
                number = np.full(found.n_docs, (int(task) << 24) + int(made))
                values = (number, pa.array(ids, pa.int64()), starts, ends - starts, np.array(crcs, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], columns)

    contents = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder).select("path", "content")
    rows = contents.mapInArrow(run, ", ".join(f"{c} long" for c in columns))
    return rows.join(first_tokens(files), "file").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def stored(docs: DataFrame, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as they stand in files written to a new folder of the shared one."""
    spark = docs.sparkSession
    folder = fresh_dir(spark, "token-files")
    files = write(docs, tokenizer, folder, end_id, id_col, text_col)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, files)
