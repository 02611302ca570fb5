"""Fill-in-middle transformation of whole texts; cuts are found by a Fenwick tree over fixed blocks.

1. A text's units are its lines, each with its line feed. Its bytes are divided into blocks of a fixed size, and a Fenwick tree
   holds for each block how many units end there and how many code points begin there.
2. The end of unit k is found by binary-lifting descent: from the root down it skips the blocks before the one in which unit k
   ends, adding their counts of units and code points. The end itself and the code points before it are then counted in that
   block alone.
3. Which units are cut, and the order of the parts, follows from a hash of a seed and the document's id, so a run can be
   repeated and no two tasks need to agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import slices, text_or_empty
from docwright.llm.words import text_bytes

BLOCK_BYTES = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50
_RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


class Blocks:
    """Units and code points of one text in blocks, as a Fenwick tree of two counts."""

    def __init__(self, data: np.ndarray, block: int = BLOCK_BYTES) -> None:
        self._data, self._block = data, block
        starts = np.arange(0, len(data), block)
        self._size = len(starts)
        self.n_units = 0
        self._tree = np.zeros((self._size + 1, 2), dtype=np.int64)
        if self._size:
            self._tree[1:, 0] = np.add.reduceat(data == 0x0A, starts, dtype=np.int64)
            self._tree[1:, 1] = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
            self.n_units = int(self._tree[1:, 0].sum()) + (data[-1] != 0x0A)
        step = 1
        while step < self._size:  # each node adds its counts to its parent, level by level
            low = np.arange(step, self._size + 1, 2 * step)
            low = low[low + step <= self._size]
            self._tree[low + step] += self._tree[low]
            step *= 2

    def end_of(self, units: int) -> tuple[int, int]:
        """The byte and the code point at which so many units have ended."""
        if units <= 0:
            return 0, 0
        at, ended, codes = 0, 0, 0
        step = 1 << max(0, self._size.bit_length() - 1) if self._size else 0
        while step:
            if at + step <= self._size and ended + self._tree[at + step, 0] < units:
                at += step
                ended, codes = ended + int(self._tree[at, 0]), codes + int(self._tree[at, 1])
            step >>= 1
        begin = at * self._block
        if at == self._size:  # the last unit has no line feed
            return len(self._data), codes
        own = self._data[begin:begin + self._block]
        end = int(np.flatnonzero(own == 0x0A)[units - ended - 1]) + 1
        return begin + end, codes + int(((own[:end] & 0xC0) != 0x80).sum())


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and the id; a null id is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))


def transform_text(data: np.ndarray, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and middle, output in UTF-8) of one text in UTF-8."""
    raw, blocks = data.tobytes(), Blocks(data)
    n = blocks.n_units
    h1, h2, h3, h4 = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not raw or any(m in raw for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, before), (b, upto) = blocks.end_of(first), blocks.end_of(second)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = marks
    if h4 % 100 < spm_rate:
        return n, "spm", before, upto - before, s + suffix + p + prefix + m + middle
    return n, "psm", before, upto - before, p + prefix + s + suffix + m + middle


def _transformed(seed: int, rate: int, spm_rate: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            ids = part.column("doc_id").to_pylist()
            made = [transform_text(data[a:b], i, seed, rate, spm_rate) for i, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            n, form, before, middle, output = zip(*made, strict=True)
            yield pa.record_batch({
                "doc_id": part.column("doc_id"), "n": pa.array(n, pa.int64()), "form": pa.array(form, pa.string()), "prefix_chars": pa.array(before, pa.int64()),
                "middle_chars": pa.array(middle, pa.int64()), "output": pa.array(output, pa.binary()).cast(pa.string())})
    return run


def transform(documents: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    `rate` of 100 documents are cut, `spm_rate` of 100 cut ones begin with the suffix. The form is plain, and the output the text, where the text
    is null or empty or holds one of the three marks. A null id is a value like any other, so rows of null id are cut by the same numbers;
    repeated rows give repeated results. Extra columns are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(_transformed(seed, rate, spm_rate), f"doc_id long, {_RESULT}")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from; the marks stand nowhere else in it."""
    def part(mark: str, until: str | None = None) -> Column:
        first = F.instr(output, F.lit(mark)) + len(mark)
        return F.substring(output, first, F.length(output) if until is None else F.instr(output, F.lit(until)) - first)

    psm = F.concat(part(PREFIX, SUFFIX), part(MIDDLE), part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), part(MIDDLE), part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
