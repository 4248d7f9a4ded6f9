"""Token ids in binary shards, with keyed access through minimal perfect hashes.

Documents are range-partitioned by id; a task encodes its range and writes one shard. A shard
is a header of HEADER bytes (magic, width of an id, zeros) and the raw little-endian ids of its
documents, one after another; ids of a vocabulary of up to 65,536 take two bytes, others four.
The index is dealt by a hash of the document key to files of about KEYS_PER_FILE keys. Each is a
minimal perfect hash from keys to shard, offset and length, with stored fingerprints.

Reading goes from keys to index files, from there to shards, and through every shard in order
of the offsets.

A text is encoded word by word: the tokenizer's pieces never cross white space, so the ids of
a text are those of its white-space separated words in sequence, and a word's ids are kept.
Tokenizers of which that is not true are encoded with ``by_words=False``.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import mph
from tidemill.llm.files import Reader, new_name, opened
from tidemill.llm.shared import small, stored, utf8
from tidemill.runtime import scratch_path

MAGIC = b"TIDSHRD1"
HEADER = 16
END_ID = 1
KEYS_PER_FILE = 16_384
# Words a Python worker keeps with their ids and parts, about 300 bytes each; emptied when full.
MEMO = 800_000
# Marks that may end a word.
MARKS = b".,;:!?"
# Words of a-z and the small letters of Latin-1, in UTF-8.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

_RECORD = pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("file", pa.string()), ("begin", pa.int64()), ("n_tokens", pa.int64())])


class _Known(dict):
    """Numbers of what was asked for, in order of appearance, and the ids of each number."""

    def __init__(self, dtype: np.dtype):
        self.new: list[bytes] = []
        # The ids of number c are ids[begin[c] : begin[c + 1]].
        self.ids, self.begin = np.empty(0, dtype), np.zeros(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        code = self[word] = len(self)
        return code

    def numbers(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def learn(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of what is new, one after the other."""
        self.new = []
        self.ids = np.concatenate([self.ids, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a sequence of numbers, and where those of each end."""
        size = self.begin[codes + 1] - self.begin[codes]
        stop = np.cumsum(size)
        return self.ids[np.repeat(self.begin[codes] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)], stop


class Encoder:
    """Texts to raw ids.

    ``fold`` says three things of a tokenizer with byte-level pieces: a word of Latin letters
    (A-Z, a-z, and the small letters of Latin-1) is one piece, which normalization leaves as it
    is but for A-Z, and A-Z count as a-z; marks at the end of such a word are pieces of their own. Then ``Word,`` needs no
    encoding where ``word`` and ``,`` are known, and ``word`` goes to the model without the
    steps before it.
    """

    _known: dict[tuple, Encoder] = {}

    @classmethod
    def shared(cls, vocabulary: str, by_words: bool, fold: bool) -> Encoder:
        """One encoder per Python worker, whose words serve all tasks that the worker runs."""
        key = (hash(vocabulary), by_words, fold)
        if key not in cls._known:
            cls._known[key] = cls(vocabulary, by_words, fold=fold)
        return cls._known[key]

    def __init__(self, vocabulary: str, by_words: bool = True, end_id: int = END_ID, fold: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(vocabulary)
        if fold:
            self.model_only = Tokenizer.from_str(vocabulary)
            self.model_only.normalizer = normalizers.Sequence([])
            self.model_only.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype)
        self.by_words, self.fold = by_words, fold
        self._clear()

    def _clear(self) -> None:
        self.words, self.parts = _Known(self.dtype), _Known(self.dtype)
        # The end of a text has the number 0.
        self.words[None] = 0
        self.words.learn(self.end, np.ones(1, np.int64))

    def _encoded(self, texts: list[bytes], by=None) -> list[list[int]]:
        return [e.ids for e in (by or self.tokenizer).encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _learned(self, known: _Known) -> None:
        """Encode what is new, all at once."""
        plain = [self.fold and _PLAIN.fullmatch(w) is not None for w in known.new]
        short = iter(self._encoded([w for w, p in zip(known.new, plain) if p], self.model_only) if self.fold else ())
        long = iter(self._encoded([w for w, p in zip(known.new, plain) if not p]))
        found = [next(short) if p else next(long) for p in plain]
        known.learn(np.fromiter(chain.from_iterable(found), self.dtype), np.array([len(ids) for ids in found], np.int64))

    def _composed(self) -> None:
        """The ids of new words from those of their parts."""
        parts, ends = [], []
        for word in self.words.new:
            base = word.rstrip(MARKS)
            if _PLAIN.fullmatch(low := base.lower()):
                parts.append(low)
                if len(base) < len(word):
                    parts.append(word[len(base) :])
            else:
                parts.append(word)
            ends.append(len(parts))
        numbers = self.parts.numbers(parts)
        if self.parts.new:
            self._learned(self.parts)
        ids, stop = self.parts.gather(numbers)
        self.words.learn(ids, np.diff(stop[np.array(ends, np.int64) - 1], prepend=0))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text, with the end id."""
        if not self.by_words:
            return [np.append(np.array(ids, self.dtype), self.end).tobytes() for ids in self._encoded(texts)]
        if len(self.words) > MEMO:
            self._clear()
        words: list[bytes | None] = []
        ends = []
        for text in texts:
            words += text.split()
            words.append(None)
            ends.append(len(words))
        numbers = self.words.numbers(words)
        if self.words.new:
            self._composed() if self.fold else self._learned(self.words)
        ids, stop = self.words.gather(numbers)
        cut = [0, *stop[np.array(ends, np.int64) - 1].tolist()]
        return [ids[b:e].tobytes() for b, e in zip(cut, cut[1:])]


def write_shards(docs: DataFrame, folder: str, vocabulary: str, by_words: bool = True, fold: bool = False) -> DataFrame:
    """Write the shards below ``folder``; ``doc_id, shard, file, begin, n_tokens`` per document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = TaskContext.get().partitionId()
        encoder, file, name, begin = None, None, new_name("shard", number, "ids"), 0
        for batch in small(batches):
            if file is None:
                encoder = Encoder.shared(shared.value, by_words, fold)
                store, path = opened(folder)
                store.create_dir(path)
                file = store.open_output_stream(f"{path}/{name}", compression=None)
                file.write((MAGIC + bytes([encoder.dtype.itemsize])).ljust(HEADER, b"\0"))
            payloads = encoder.encode(utf8(batch.column(1)))
            file.write(b"".join(payloads))
            sizes = np.array([len(p) // encoder.dtype.itemsize for p in payloads], np.int64)
            begins = begin + np.cumsum(sizes) - sizes
            begin += int(sizes.sum())
            n = len(payloads)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(n, number)), pa.array([name] * n), pa.array(begins), pa.array(sizes)], schema=_RECORD
            )
        if file is not None:
            file.close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(run, "doc_id bigint, shard bigint, file string, begin bigint, n_tokens bigint")


def shard_table(records: DataFrame) -> DataFrame:
    """``shard, file, base``: one row per shard, with the ids of all shards before it."""
    sizes = records.groupBy("shard", "file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", "file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _key(doc_id, copy) -> np.ndarray:
    """64-bit keys of document ids; several rows of one id are told apart by ``copy``."""
    none = np.array([v is None for v in doc_id], np.uint64)
    ids = np.array([v or 0 for v in doc_id], np.int64).view(np.uint64)
    copies = np.array(copy, np.int64).view(np.uint64)
    return mph.mix(ids ^ mph.mix(copies * np.uint64(2) + none))


def _files(keys: DataFrame, n: int) -> DataFrame:
    return keys.withColumn("index_file", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(n)))


def build_index(records: DataFrame, folder: str) -> DataFrame:
    """Write the index files; ``index_file, name, files`` with one row per file."""
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("shard", "begin")) - 1
    files = max(1, -(-records.count() // KEYS_PER_FILE))

    def run(table: pa.Table) -> pa.Table:
        number = table.column("index_file")[0].as_py()
        keys = _key(table.column("doc_id").to_pylist(), table.column("copy").to_pylist())
        data = mph.packed(keys, {c: table.column(c).to_numpy().astype("<i8") for c in ("shard", "begin", "n_tokens")})
        name = new_name("index", number, "mph")
        store, path = opened(folder)
        store.create_dir(path)
        with store.open_output_stream(f"{path}/{name}", compression=None) as file:
            file.write(data)
        return pa.table({"index_file": pa.array([number], pa.int64()), "name": [name], "files": pa.array([files], pa.int64())})

    keyed = _files(records.select("doc_id", copy.cast("bigint").alias("copy"), "shard", "begin", "n_tokens"), files)
    made = keyed.groupBy("index_file").applyInArrow(run, "index_file bigint, name string, files bigint")
    return stored(made, "token-index")


class TokenStore:
    """Shards and index of one table."""

    def __init__(self, folder: str, shards: DataFrame, index: DataFrame):
        self.folder, self.shards, self.index = folder, shards, index

    def locate(self, keys: DataFrame) -> DataFrame:
        """``doc_id, copy, shard, begin, n_tokens`` of the keys ``doc_id, copy`` that are there."""
        row = self.index.select("files").limit(1).collect()
        files = row[0]["files"] if row else 1
        folder = self.folder
        names = ["doc_id", "copy", "shard", "begin", "n_tokens"]

        def run(table: pa.Table) -> pa.Table:
            store, path = opened(folder)
            with store.open_input_file(f"{path}/{table.column('name')[0].as_py()}") as file:
                index = mph.Index(file.read())
            ids, copies = table.column("doc_id"), table.column("copy")
            there, values = index.find(_key(ids.to_pylist(), copies.to_pylist()))
            mask = pa.array(there)
            return pa.table([ids.filter(mask), copies.filter(mask), *(pa.array(values[n], pa.int64()) for n in names[2:])], names=names)

        dealt = _files(keys.select("doc_id", "copy"), files).join(self.index.select("index_file", "name"), "index_file")
        return dealt.groupBy("index_file").applyInArrow(run, ", ".join(f"{n} bigint" for n in names))

    def read(self, located: DataFrame) -> DataFrame:
        """``doc_id, copy, start, n_tokens, ids``: the raw ids of located documents as binary."""
        return self._mapped(located, lambda ids: ids.astype("<u4").tobytes(), "ids", "binary")

    def checksums(self, located: DataFrame) -> DataFrame:
        """``doc_id, copy, start, n_tokens, ids_crc32`` of located documents."""
        return self._mapped(located, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32", "bigint")

    def _mapped(self, located: DataFrame, function, name: str, kind: str) -> DataFrame:
        folder = self.folder
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "copy", "start", "n_tokens")] + [(name, pa.binary() if kind == "binary" else pa.int64())])

        def run(batches):
            reader, shard, dtype = Reader(folder), None, None
            for batch in batches:
                ids, copies, files, bases, begins, sizes = (batch.column(i).to_pylist() for i in range(6))
                starts, made = [], []
                for file, base, begin, n in zip(files, bases, begins, sizes):
                    if file != shard:
                        head = reader.read(file, 0, HEADER)
                        if head[:8] != MAGIC:
                            raise ValueError(f"{file} is not a shard")
                        shard, dtype = file, np.dtype(f"<u{head[8]}")
                    data = reader.read(file, HEADER + begin * dtype.itemsize, n * dtype.itemsize)
                    starts.append(base + begin)
                    made.append(function(np.frombuffer(data, dtype)))
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((ids, copies, starts, sizes, made), schema)], schema=schema)
            reader.close()

        rows = located.join(self.shards, "shard").select("doc_id", "copy", "file", "base", "begin", "n_tokens")
        # A task per shard: the rows are few bytes, the work is in what they point to.
        ordered = rows.repartition(max(1, self.shards.count()), "file").sortWithinPartitions("file", "begin")
        return ordered.mapInArrow(run, f"doc_id bigint, copy bigint, start bigint, n_tokens bigint, {name} {kind}")


def tokenize_to_store(docs: DataFrame, vocabulary_file: str, by_words: bool = True, fold: bool = False) -> TokenStore:
    """Encode ``docs`` and write shards and index below the shared folder.

    ``vocabulary_file`` is read on the driver and sent to the tasks; ``by_words`` and ``fold``
    say what is true of the tokenizer (see the module and ``Encoder``). Every row gets a record, in
    the order of ``doc_id`` with null ids first; rows of one id have the copies 0, 1 and so on.
    A null text is empty and has the end id only. Columns other than ``doc_id`` and ``text`` are
    not read. An empty table has no shards and finds no key.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        vocabulary = file.read()
    folder = scratch_path(docs.sparkSession, "token-shards")
    records = stored(write_shards(docs, folder, vocabulary, by_words, fold), "token-records")
    shards = stored(shard_table(records), "token-shard-table")
    return TokenStore(folder, shards, build_index(records, folder))


def document_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, copy``: a key for every row of ``docs``."""
    counted = docs.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"))
