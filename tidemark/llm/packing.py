"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each document is cut into full windows plus a remainder. A remainder goes to the fill level whose use leaves the
smallest sum of squared counts of partially filled windows; the counts live in one level array per task. Every scan
partition packs its own documents (no shuffle). At its end, or when ``max_open`` windows are open, the emptiest windows
are cut up to fill the others, so at most one padded window per call of that step remains.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
# Fixed value: the published pre-tokenisation pattern of this byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the added token of the vocabulary file, which the rank file leaves out. In a text it is one id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
# The pattern's blanks (White_Space). tiktoken's matcher panics on about a million in a row, so longer runs go round it.
LONG_RUN = 100_000
RUNS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_ENCODERS: dict[str, object] = {}


def _encoder(ranks: str):
    """tiktoken encoder of a rank file, one per worker.

    The rank file holds the vocabulary of the byte-level BPE JSON file; both libraries give the same ids (tested), and
    tiktoken needs a third of the CPU time.
    """
    if ranks not in _ENCODERS:
        import tiktoken
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
        _ENCODERS[ranks] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _ENCODERS[ranks]


def encode(encoder, text: str) -> list[int]:
    """Ids of a text. A long run of blanks is one pre-token, without its last blank if something follows."""
    if SPECIAL in text:
        out = []
        for part in text.split(SPECIAL):
            out += [*encode(encoder, part), SPECIAL_ID]
        return out[:-1]
    if len(text) < LONG_RUN:
        return encoder.encode_ordinary(text)
    out, at = [], 0
    for run in RUNS.finditer(text):
        out += encoder.encode_ordinary(text[at:run.start()])
        at = run.end() - (run.end() < len(text))
        out += encoder._encode_single_piece(text[run.start():at])
    return out + encoder.encode_ordinary(text[at:])


class Packer:
    """Level array of open windows; ``rows`` collects the pieces of closed ones."""

    def __init__(self, size: int, first_id: int, max_open: int):
        self.size, self.next_id, self.max_open = size, first_id, max_open
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]  # by fill: windows, each a list of pieces
        self.n_open = 0
        self.rows: list[tuple] = []

    def close(self, window: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in window:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, at))
            at += n
        self.next_id += 1

    def add(self, doc, ids: bytes) -> None:
        total, at, step = len(ids) // 4, 0, self.size * 4
        while len(ids) - at >= step:
            self.close([(doc, at // 4, ids[at:at + step], total)])
            at += step
        if at < len(ids):
            self.place((doc, at // 4, ids[at:], total))
            if self.n_open > self.max_open:
                self.drain()

    def place(self, piece: tuple) -> None:
        s = len(piece[2]) // 4
        c = self.count
        # Change of the sum of squares for each level h (0: a new window) with room for s.
        room = self.size - s
        change = 2 * c[s:self.size + 1] + 1
        change[room] = 0                       # a window that becomes full is no longer partial
        change[1:] += 1 - 2 * c[1:room + 1]
        change[1:][c[1:room + 1] == 0] = np.iinfo(np.int64).max
        h = int(change.argmin())
        if h:
            window = self.open[h].pop()
            c[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if h + s == self.size:
            self.close(window)
        else:
            self.open[h + s].append(window)
            c[h + s] += 1
            self.n_open += 1

    def drain(self) -> None:
        """Close every open window: cut the emptiest to fill the fullest; one padded window at most remains."""
        windows = [w for level in self.open for w in level]  # by fill, emptiest first
        fills = [sum(len(p[2]) // 4 for p in w) for w in windows]
        self.open = [[] for _ in range(self.size + 1)]
        self.count[:] = 0
        self.n_open = 0
        low, high = 0, len(windows) - 1
        while low < high:
            gap = self.size - fills[high]
            while gap and low < high:
                doc, start, ids, total = windows[low].pop()
                n = len(ids) // 4
                take = min(n, gap)
                windows[high].append((doc, start + n - take, ids[(n - take) * 4:], total))
                if take < n:
                    windows[low].append((doc, start, ids[:(n - take) * 4], total))
                gap -= take
                fills[low] -= take
                fills[high] += take
                if not windows[low]:
                    low += 1
            if not gap:
                self.close(windows[high])
                high -= 1
        if low == high and windows[low]:
            self.close(windows[low])


def pack(docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", size: int = WINDOW, end_id: int = 0,
         max_open: int = 4096) -> DataFrame:
    """Pieces of every document in windows of ``size`` tokens (schema ``PIECES``).

    A document's ids end with ``end_id``; a null or empty text has that id alone. Every id lies in exactly one piece;
    ``sequence_id`` is (task partition << 36) + a running number and ``offset`` is gapless from 0. Null ids and
    repeated rows are packed like any other row; an empty table gives no rows; other columns are ignored. The result
    is a function of the rows of each scan partition, so a task that runs again repeats it.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        packer = Packer(size, TaskContext.get().partitionId() << 36, max_open)
        end = np.array([end_id], "<u4").tobytes()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [()] * len(names)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        encoder = _encoder(ranks)
        for b in batches:
            for k, t in zip(b.column("k").to_pylist(), b.column("t")):   # ids as Python integers: a null beside them costs no digit
                packer.add(k, np.array(encode(encoder, t.as_py() or ""), "<u4").tobytes() + end)
                if len(packer.rows) > 10_000:
                    yield rows()
        packer.drain()
        yield rows()

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInArrow(run, PIECES)


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1(docs: DataFrame) -> DataFrame:
    return pack(docs, ranks_path())
