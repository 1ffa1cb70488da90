"""Order-preserving packing of token sequences by dynamic programming.

Documents are tokenized and laid out in table order as one stream per input partition. Windows of at most ``length`` ids
are cut from it where padding plus truncation penalties are least: a cut between documents is free, one behind a sentence
costs little, any other one more. With f(j) the least cost of the first j ids,

    f(j) = penalty(j) + length - j + min over i in [j - length, j) of (f(i) + i),

so the minimum slides over the candidate cuts and a monotone queue gives it in constant time. The stream is handled in
stretches; a stretch's last window is carried into the next, so memory stays bounded and only a partition's last window
is cut short. No shuffle.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; an empty table
gives no rows; a null doc_id stays null; further columns take no part.
"""

from __future__ import annotations

import base64
import json
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 1024
SENTENCE, HARD, GRID = 0.5, 2.0, 8
STRETCH = 1 << 18
#: White space in a row from which on the faster coder is not asked.
BLANKS = 10_000
SENTENCE_ENDS = (b".", b"!", b"?", b"\n", "。".encode(), "！".encode(), "？".encode())
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Ids:
    """Token ids of texts as little-endian 32-bit bytes: those of the `tokenizers` file, with its own switches and no special ids added.

    ranks: the same vocabulary's ranks, which a faster coder reads. It takes all texts but those that hold a special token's
    string, and those with a run of blanks that its pattern can't go back over; the file's coder, loaded when needed, takes these.
    """

    def __init__(self, file: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as lines:
            words = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        with open(file, encoding="utf-8") as whole:
            text = whole.read()
        # the rest of the file is the vocabulary, which the ranks hold already
        tokens, _ = json.JSONDecoder().raw_decode(text, text.index("[", text.index('"added_tokens"')))
        added = [(token["content"], token["id"]) for token in tokens]
        self.file, self.exact = file, None
        self.odd = re.compile("|".join([r"\s{%d}" % BLANKS, *(re.escape(content) for content, _ in added)]))
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=words, special_tokens={})
        self.marks = np.zeros(max([*words.values(), *(k for _, k in added)]) + 1, bool)
        for word, rank in words.items():
            self.marks[rank] = word.endswith(SENTENCE_ENDS)

    def of(self, text: str) -> bytes:
        if not self.odd.search(text):
            return self.coder.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.file)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cuts(ends: np.ndarray, sentence: np.ndarray, length: int, sentence_cost: float = SENTENCE, hard_cost: float = HARD, grid: int = GRID) -> list[int]:
    """Best window ends of a stream of len(sentence) ids. ends: where documents end; sentence: ids that end a sentence."""
    n = len(sentence)
    cost = np.full(n + 1, np.inf)
    cost[np.flatnonzero(sentence) + 1] = sentence_cost
    cost[ends] = 0.0
    cost[n] = 0.0
    at = np.flatnonzero(np.isfinite(cost))
    # a stretch without a boundary gets hard cuts at every grid-th id, so every window can be filled
    gaps = np.diff(np.concatenate([[0], at]))
    long = np.flatnonzero(gaps > grid)
    if len(long):
        begins = at[long] - gaps[long]
        times = (gaps[long] - 1) // grid
        steps = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
        hard = np.repeat(begins, times) + steps * grid
        cost[hard] = hard_cost
        at = np.flatnonzero(np.isfinite(cost))
    places, costs = [0, *at.tolist()], [0.0, *cost[at].tolist()]
    total, back = [0.0] * len(places), [0] * len(places)
    queue: deque[int] = deque([0])  # candidates whose total + place grows
    keys = [0.0] * len(places)
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - length:
            queue.popleft()
        i = queue[0]
        total[j] = costs[j] + length - place + keys[i]
        back[j] = i
        key = keys[j] = total[j] + place
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out, j = [], len(places) - 1
    while j:
        out.append(places[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Packs documents that come one after the other; rows() has the finished pieces."""

    def __init__(self, length: int, marks: np.ndarray, first_sequence: int):
        self.length, self.marks, self.sequence = length, marks, first_sequence
        self.docs: list[list] = []  # [doc_id, ids as bytes, start of the rest, size of the document]
        self.waiting = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append([doc_id, ids, 0, len(ids) // 4])
        self.waiting += len(ids) // 4

    def rows(self, last: bool) -> list[tuple]:
        """Pieces of all windows but the stream's last one, which waits for more unless last."""
        if not self.waiting:
            return []
        stream = np.frombuffer(b"".join(d[1][4 * d[2] :] for d in self.docs), "<u4")
        ends = np.cumsum([d[3] - d[2] for d in self.docs])
        windows = cuts(ends, self.marks[stream], self.length)
        windows = windows if last else windows[:-1]
        out, k, begin = [], 0, 0
        for end in windows:
            offset = 0
            while offset < end - begin:
                doc = self.docs[k]
                take = min(doc[3] - doc[2], end - begin - offset)
                out.append((doc[0], doc[2], take, doc[1][4 * doc[2] : 4 * (doc[2] + take)], doc[3], self.sequence, offset))
                doc[2] += take
                offset += take
                k += doc[2] == doc[3]
            begin = end
            self.sequence += 1
        self.docs = self.docs[k:]
        self.waiting -= begin
        return out


def packer(coder: tuple[str, str, str], length: int, end_id: int):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = Ids(*coder), np.array([end_id], "<u4").tobytes()
        made = Packer(length, ids.marks, TaskContext.get().partitionId() << 40)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for got in batches:
            for key, text in zip(got.column("doc_id"), got.column("text"), strict=True):
                made.add(key.as_py(), ids.of(text.as_py() or "") + end)
                if made.waiting >= STRETCH and (rows := made.rows(False)):
                    yield batch(rows)
        if rows := made.rows(True):
            yield batch(rows)

    return pack


def pack(docs: DataFrame, coder: tuple[str, str, str], length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """PIECES of every document: ids (little-endian unsigned 32-bit), where they start in it and where they lie in a sequence.

    coder: paths of a `tokenizers` file and of its ranks, and the pattern that parts words. Every input partition ends in a window that
    is cut short, so many small files cost a window each; repartition them first if that matters.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(packer(coder, length, end_id), PIECES)


def with_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
