"""Token ids in binary files whose document boundaries are Elias-Fano coded.

Each range of ascending doc_id becomes one file:

    ids             all ids in a row, little-endian, 2 or 4 bytes each
    bounds          Elias-Fano code of where each document ends (n_docs + 1 values from 0)
    doc_ids         Elias-Fano code of doc_id - first doc_id
    footer          JSON (sizes, widths, section lengths), its length (4 bytes), "EFID"

An Elias-Fano code splits a value of a rising list into ``low_bits`` stored plainly and the
rest stored in unary in a bit vector; the place of every 256th one is kept (4 bytes), so that
``select`` finds any value without reading the list.  A boundary costs about
2 + log2(ids per document) bits instead of 64.

Cases: null text is empty and still gets the end id; null doc_ids come first and stay null;
repeated rows are written as often as they occur, ties in any order; an empty table gives no
files; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinedeck.llm.common import settle, shared_folder, ship
from brinedeck.llm.token_ids import encode_column, encoder, id_width, read_tokenizer

MAGIC = b"EFID"
SAMPLE = 256
#: Ids held in memory at a time when files are read.
WINDOW = 2 << 20

ship(__name__)


class EliasFano:
    """A rising list of non-negative numbers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = []
        for at in range(0, n, 8192):  # a multiple of 8, so that each block ends on a byte
            block = values[at : at + 8192, None] >> np.arange(bits, dtype=np.uint64)
            low.append(np.packbits((block & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(((top >> bits) + n + 8) // 8, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(n, bits, np.concatenate(low) if low else np.zeros(0, np.uint8), high, ones[::SAMPLE].astype("<u4"))

    def sections(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]

    @classmethod
    def read(cls, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> EliasFano:
        return cls(n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4"))

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros(len(index), np.uint64)
        for bit in range(self.low_bits):
            at = index * self.low_bits + bit
            out |= ((self.low[at >> 3] >> (at & 7)) & 1).astype(np.uint64) << np.uint64(bit)
        return out

    def select(self, i: int) -> int:
        """The ``i``-th value (from 0), from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = int(self.samples[i // SAMPLE])
        need, byte, width = i % SAMPLE, start >> 3, 64
        while True:
            bits = np.unpackbits(self.high[byte : byte + width], bitorder="little")
            bits[: start & 7] = 0
            ones = np.flatnonzero(bits)
            if len(ones) > need:
                return ((byte * 8 + int(ones[need]) - i) << self.low_bits) | int(self._low(np.array([i]))[0])
            width *= 2

    def values(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The values from ``start`` to ``stop``, decoded together."""
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, np.uint64)
        first = int(self.samples[start // SAMPLE])
        after = (stop - 1) // SAMPLE + 1
        last = int(self.samples[after]) if after < len(self.samples) else len(self.high) * 8 - 1
        byte = first >> 3
        bits = np.unpackbits(self.high[byte : (last >> 3) + 1], bitorder="little")
        bits[: first & 7] = 0
        skip = start - start // SAMPLE * SAMPLE
        ones = np.flatnonzero(bits)[skip : skip + stop - start] + byte * 8
        index = np.arange(start, stop)
        return ((ones - index).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(index)


def _open(uri: str):
    """File system and path of a folder; anything with a scheme that pyarrow knows, or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1) -> DataFrame:
    """Write the files of ``docs`` to ``folder``; returns the table of files (part, file, n_docs, n_ids), rising by part.

    Texts are dealt by doc_id range, encoded and written as they stream by; a task holds its
    documents' ends, not their ids.  A file's name is unique to the task attempt and only
    finished attempts are in the table, so a repeated task does no harm.
    """
    content, width = read_tokenizer(tokenizer), id_width(read_tokenizer(tokenizer))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        files, base = _open(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.efid"
        out, ends, doc_ids, nulls, total = None, [np.zeros(1, np.uint64)], [], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/{name}")
            sizes = []
            for ids in encode_column(encoder(content), batch["text"], end_id):
                out.write(ids.astype(f"<u{width}").tobytes())
                sizes.append(len(ids))
            ends.append(np.uint64(total) + np.cumsum(sizes).astype(np.uint64))
            total += sum(sizes)
            known = batch["doc_id"].notna()
            nulls += int((~known).sum())
            doc_ids.append(batch["doc_id"][known].to_numpy(np.int64))
        if out is None:
            return
        keys = np.concatenate(doc_ids)
        first = int(keys[0]) if len(keys) else 0
        codes = [EliasFano.of(np.concatenate(ends)), EliasFano.of(keys.view(np.uint64) - np.uint64(first % (1 << 64)))]
        sections = [s for code in codes for s in code.sections()]
        for section in sections:
            out.write(section)
        footer = {"n_docs": codes[0].n - 1, "nulls": nulls, "n_ids": total, "width": width, "first": first, "low_bits": [c.low_bits for c in codes], "n": [c.n for c in codes], "sections": [len(s) for s in sections]}
        tail = json.dumps(footer).encode()
        out.write(tail + len(tail).to_bytes(4, "little") + MAGIC)
        out.close()
        yield pd.DataFrame({"part": [part], "file": [f"{folder}/{name}"], "n_docs": [footer["n_docs"]], "n_ids": [total]})

    placed = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    typed = placed.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(typed.mapInPandas(write, "part int, file string, n_docs long, n_ids long"))


class IdFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        files, path = _open(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        end = self.file.read_at(8, size - 8)
        if end[4:] != MAGIC:
            raise ValueError(f"not an id file: {uri}")
        length = int.from_bytes(end[:4], "little")
        self.footer = json.loads(self.file.read_at(length, size - 8 - length))
        at, parts = self.footer["n_ids"] * self.footer["width"], []
        for n in self.footer["sections"]:
            parts.append(self.file.read_at(n, at))
            at += n
        self.bounds, self.doc_ids = (EliasFano.read(n, b, *parts[3 * k : 3 * k + 3]) for k, (n, b) in enumerate(zip(self.footer["n"], self.footer["low_bits"], strict=True)))

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.footer["width"]
        return np.frombuffer(self.file.read_at((stop - start) * width, start * width), f"<u{width}").astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """Ids of the ``k``-th document of the file, found by ``select``."""
        return self.ids(self.bounds.select(k), self.bounds.select(k + 1))

    def keys(self, start: int, stop: int) -> list[int | None]:
        nulls, first = self.footer["nulls"], self.footer["first"]
        known = self.doc_ids.values(max(0, start - nulls), max(0, stop - nulls))
        return [None] * max(0, min(stop, nulls) - start) + (known + np.uint64(first % (1 << 64))).view(np.int64).tolist()


def read_ids(files: DataFrame) -> DataFrame:
    """What the files hold, one row per document: doc_id, start (over all files), n_tokens, ids_crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, base in zip(batch["file"], batch["base"], strict=True):
                source = IdFile(uri)
                n, at = source.footer["n_docs"], 0
                while at < n:
                    stop = min(n, at + 65_536)
                    bounds = source.bounds.values(at, stop + 1).astype(np.int64)
                    crcs = np.zeros(stop - at, np.int64)
                    k = 0
                    while k < stop - at:
                        end = max(k + 1, int(np.searchsorted(bounds, bounds[k] + WINDOW, "right")) - 1)
                        if bounds[end] - bounds[k] <= WINDOW:
                            held = memoryview(source.ids(int(bounds[k]), int(bounds[end]))).cast("B")
                            for j in range(k, end):
                                crcs[j] = zlib.crc32(held[4 * (bounds[j] - bounds[k]) : 4 * (bounds[j + 1] - bounds[k])])
                        else:  # one document larger than the window
                            crc = 0
                            for part in range(int(bounds[k]), int(bounds[end]), WINDOW):
                                crc = zlib.crc32(source.ids(part, min(part + WINDOW, int(bounds[end]))).tobytes(), crc)
                            crcs[k] = crc
                        k = end
                    keys = pd.array(source.keys(at, stop), dtype="Int64")
                    yield pd.DataFrame({"doc_id": keys, "start": bounds[:-1] + base, "n_tokens": np.diff(bounds), "ids_crc32": crcs})
                    at = stop

    return based.repartition("file").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_id_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """Write the files (to a new shared folder if none is named) and read them back: the table of files, and of documents."""
    files = write_ids(docs, tokenizer, folder or shared_folder(docs.sparkSession), end_id)
    return files, read_ids(files)
