"""SentencePiece encoding and decoding by a streaming Viterbi search.

Encoding picks the pieces with the greatest sum of scores. Scores are kept for a window of the last
`longest piece` characters only, as no piece reaches back further. The backpointers of the window are
followed to the boundary on which all of them meet; everything before it can't change any more, so its
ids are committed and forgotten. Where no piece crosses a boundary the paths meet in any case, so the
ids of such a unit depend on nothing around it and are remembered, up to TABLE_UNITS units a task. Units
of at most SHORT characters fit into one window; those that are new in a batch are searched together,
position by position, with arrays.
Characters outside the vocabulary become byte pieces, priced PENALTY below the least score. Of equal
paths the one with the earlier start of its last piece wins. Decoding joins the pieces' bytes.

The vocabulary's scores come with the file; nothing is trained. For a vocabulary made for merging, the
ids may differ from those of merging; the text that they decode to does not.

Defined results: null and empty texts have no ids and decode to the empty text; a meta space in a text
decodes to a space, as the format has it (exact is then false); repeated rows get the same ids; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.piece_model import META, PieceModel, piece_model, public_model_path

TABLE_UNITS = 300_000
SHORT = 48
GROUP_CHARS = 2_000_000
PENALTY = 10.0


@lru_cache(maxsize=4)
def piece_trie(path: str) -> dict:
    """Pieces by character; the key "" holds (id, score)."""
    model, root = piece_model(path), {}
    for piece, i in model.ids.items():
        node = root
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = (i, model.scores[piece])
    return root


class StreamingViterbi:
    """Feed characters with push(); committed ids are handed out as soon as they are certain."""

    def __init__(self, model: PieceModel):
        self.model, self.root = model, piece_trie(model.path)
        self.missing = model.least - PENALTY
        self.reset()

    def reset(self) -> None:
        self.text, self.done = "", 0  # characters since the last commit, and how many have been relaxed
        self.best: list[float] = [0.0]
        self.back: list[tuple[int, tuple[int, ...]]] = [(0, ())]

    def relax(self, end: int) -> None:
        """Offer all pieces that begin before the end to the positions after them."""
        text, best, back = self.text, self.best, self.back
        more = len(text) + 1 - len(best)
        best += [float("-inf")] * more
        back += [(0, ())] * more
        for i in range(self.done, end):
            base, node, single = best[i], self.root, False
            for j in range(i, len(text)):
                node = node.get(text[j])
                if node is None:
                    break
                if "" in node:
                    piece, score = node[""]
                    single |= j == i
                    if base + score > best[j + 1]:
                        best[j + 1], back[j + 1] = base + score, (i, (piece,))
            if not single and base + self.missing > best[i + 1]:
                ids = tuple(self.model.byte_ids[b] for b in text[i].encode())
                best[i + 1], back[i + 1] = base + self.missing, (i, ids)
        self.done = max(self.done, end)

    def commit(self, boundary: int) -> list[int]:
        """Ids of the best path to the boundary; what lies before it is forgotten."""
        steps, at = [], boundary
        while at:
            at, ids = self.back[at]
            steps.append(ids)
        base = self.best[boundary]
        self.text, self.done = self.text[boundary:], self.done - boundary
        self.best = [b - base for b in self.best[boundary:]]
        self.back = [(i - boundary, ids) for i, ids in self.back[boundary:]]
        self.back[0] = (0, ())
        return [i for ids in reversed(steps) for i in ids]

    def push(self, text: str) -> list[int]:
        """Take characters; returns the ids that are certain now."""
        self.text += text
        ready = len(self.text) - self.model.longest  # all pieces from here back are known in full
        if ready <= 0:
            return []
        self.relax(ready)
        open_ = {i for i in range(ready, len(self.best)) if self.best[i] > float("-inf")}  # every path uses one
        while len(open_) > 1:
            at = max(open_)
            open_.remove(at)
            open_.add(self.back[at][0])
        boundary = open_.pop()
        return self.commit(boundary) if boundary else []

    def finish(self) -> list[int]:
        self.relax(len(self.text))
        out = self.commit(len(self.text))
        self.reset()
        return out


class UnitSearch:
    """The same search for many short units at once; rows are units, columns are positions."""

    def __init__(self, model: PieceModel):
        self.longest = model.longest
        keys, self.piece, self.score = {}, [-1], [0.0]
        for text, i in model.ids.items():
            node = 0
            for c in text:
                node = keys.setdefault((node << 21) | ord(c), len(self.piece))
                if node == len(self.piece):
                    self.piece.append(-1)
                    self.score.append(0.0)
            self.piece[node], self.score[node] = i, model.scores[text]
        order = np.argsort(np.fromiter(keys, np.int64, len(keys)))
        self.keys = np.fromiter(keys, np.int64, len(keys))[order]
        self.next = np.fromiter(keys.values(), np.int32, len(keys))[order]
        self.piece, self.score = np.array(self.piece, np.int32), np.array(self.score)

    def step(self, node: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which rows go on, and their next nodes."""
        key = (node.astype(np.int64) << 21) | chars
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        on = np.flatnonzero(self.keys[at] == key)
        return on, self.next[at[on]]

    def ids(self, units: list[str]) -> list[bytes | None]:
        """Ids of each unit; None for one with a character outside the vocabulary."""
        sizes = np.array([len(u) for u in units])
        order = np.argsort(-sizes, kind="stable")
        sizes, width = sizes[order], int(sizes[order[0]])
        chars = np.array([units[k] for k in order], f"U{width}").view(np.uint32).reshape(len(units), width).astype(np.int64)
        active = np.searchsorted(-sizes, -np.arange(width), side="left")  # rows longer than each position
        best = np.full((len(units), width + 1), -np.inf)
        back, piece = np.zeros((len(units), width + 1), np.int8), np.zeros((len(units), width + 1), np.int32)
        best[:, 0] = 0
        for i in range(width):
            rows, node = np.arange(active[i]), np.zeros(active[i], np.int32)
            for end in range(i, min(width, i + self.longest)):
                keep = np.searchsorted(rows, active[end])
                rows, node = rows[:keep], node[:keep]
                on, node = self.step(node, chars[rows, end])
                rows = rows[on]
                if not len(rows):
                    break
                ends = np.flatnonzero(self.piece[node] >= 0)
                value = best[rows[ends], i] + self.score[node[ends]]
                better = value > best[rows[ends], end + 1]
                ends, r = ends[better], rows[ends[better]]
                best[r, end + 1], back[r, end + 1], piece[r, end + 1] = value[better], i, self.piece[node[ends]]
        at, out = sizes.copy(), np.full((len(units), width), -1, np.int32)
        found = best[np.arange(len(units)), sizes] > -np.inf
        column, rows = width, np.flatnonzero(found)
        while len(rows):
            column -= 1
            out[rows, column] = piece[rows, at[rows]]
            at[rows] = back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        counts = (out >= 0).sum(axis=1)
        # each row's ids end in different columns of its own steps: close the gaps
        raw, edges = out[out >= 0].tobytes(), np.concatenate([[0], np.cumsum(counts)]) * 4
        result: list[bytes | None] = [None] * len(units)
        for k, unit in enumerate(order.tolist()):
            if found[k]:
                result[unit] = raw[edges[k] : edges[k + 1]]
        return result


@lru_cache(maxsize=4)
def unit_search(path: str) -> UnitSearch:
    return UnitSearch(piece_model(path))


class Codec:
    """Ids of texts and texts of ids."""

    def __init__(self, path: str):
        self.model = piece_model(path)
        self.stream, self.search = StreamingViterbi(self.model), unit_search(path)
        self.known: dict[str, bytes] = {}

    def unit_ids(self, unit: str) -> bytes:
        ids: list[int] = []
        for low in range(0, len(unit), 64):
            ids += self.stream.push(unit[low : low + 64])
        ids += self.stream.finish()
        return np.array(ids, np.int32).tobytes()

    def learn(self, units: set[str]) -> None:
        """Search the units that are not remembered yet."""
        new = list(units - self.known.keys())
        short = [u for u in new if len(u) <= SHORT]
        for low in range(0, len(short), 50_000):
            part = short[low : low + 50_000]
            self.known.update((u, ids) for u, ids in zip(part, self.search.ids(part), strict=True) if ids is not None)
        for u in new:
            if u not in self.known:
                self.known[u] = self.unit_ids(u)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, in groups of texts so that the table stays bounded."""
        out, low = [], 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= GROUP_CHARS):
                size += len(texts[high])
                high += 1
            if len(self.known) > TABLE_UNITS:
                self.known.clear()
            units = [self.model.units(t) for t in texts[low:high]]
            self.learn(set().union(*units))
            out += [np.frombuffer(b"".join(map(self.known.__getitem__, u)), np.int32) for u in units]
            low = high
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.model.bytes_of.__getitem__, ids))[1:]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Per row: id, n_ids, ids, and exact (decoding the ids gives the text back)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path or public_model_path())
        for batch in batches:
            texts = batch.column("_text").fill_null("").to_pylist()
            ids = codec.encode_all(texts)
            exact = [codec.decode(x.tolist()) == t.encode() for x, t in zip(ids, texts, strict=True)]
            sizes = np.array([len(x) for x in ids], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.record_batch({"_id": batch.column("_id"), "n_ids": pa.array(sizes),
                                   "ids": pa.ListArray.from_arrays(offsets, values), "exact": pa.array(exact, pa.bool_())})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n_ids long, ids array<int>, exact boolean").withColumnRenamed("_id", id_col)


def decoded(ids: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """Per row: id and the text of its ids; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path or public_model_path())
        for batch in batches:
            texts = [codec.decode(x or []).decode("utf-8", "replace") for x in batch.column("_ids").to_pylist()]
            yield pa.record_batch({"_id": batch.column("_id"), "text": pa.array(texts, pa.string())})

    rows = ids.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)
