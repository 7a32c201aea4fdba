"""Token counts by memoised library counts of units, composed over chunks.

A unit is a stretch of text that no piece of the vocabulary can cross. Its number of tokens comes from
the library itself, once for each unit, and is kept in a table that is dropped when it holds TABLE_UNITS.
This stands in place of a transducer compiled from the vocabulary: there are no states or transitions
below units, as the library's own merging is what the counts must equal.

A chunk of a text is a map of states: (what it adds to the unit that is open before it, tokens
inside, unit left open after it). Maps compose associatively; the chunks of a text over CHUNK characters
are composed pairwise in rounds, one after another in the task that has the text.

Defined results: null and empty texts have 0 tokens; repeated rows are counted alike; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.piece_model import META, library, piece_model, public_model_path

CHUNK = 1 << 16
TABLE_UNITS = 400_000
LIMIT = 4096


@dataclass(frozen=True)
class ChunkMap:
    """Effect of a chunk: head joins the unit open before it; if it is not closed, head is all."""

    head: str
    closed: bool
    tokens: int
    tail: str


class CountTransducer:
    """Emitted-token counts by unit, and the composition of chunk maps."""

    def __init__(self, path: str):
        self.model, self.library = piece_model(path), library(path)
        self.emits: dict[str, int] = {}
        self.lead = len(self.library.encode("\n"))

    def compile(self, units: list[str]) -> None:
        """Add the transitions that end these units.

        A unit is encoded behind a line break, which no piece crosses, so no meta space is put before it.
        """
        if len(self.emits) + len(units) > TABLE_UNITS:
            self.emits.clear()
        codes = self.library.encode(["\n" + u for u in units], num_threads=1)
        self.emits.update((u, len(c) - self.lead) for u, c in zip(units, codes, strict=True))

    def count(self, units: list[str]) -> int:
        try:
            return sum(map(self.emits.__getitem__, units))
        except KeyError:
            new = [u for u in set(units) if u not in self.emits]
            table = self.emits
            if len(table) + len(new) > TABLE_UNITS:
                new = list(set(units))
            for low in range(0, len(new), TABLE_UNITS // 2):
                self.compile(new[low : low + TABLE_UNITS // 2])
            if all(u in table for u in new):
                return sum(map(table.__getitem__, units))
            return sum(len(self.library.encode("\n" + u)) - self.lead for u in units)

    def chunk_map(self, chunk: str) -> ChunkMap:
        """Map of a chunk whose spaces are meta spaces already."""
        units = self.model.unit.findall(chunk)
        if len(units) < 2:
            return ChunkMap(chunk, False, 0, "")
        return ChunkMap(units[0], True, self.count(units[1:-1]), units[-1])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if not b.closed and not a.closed:
            return self.joined(a.head + b.head)
        if not a.closed:
            left = self.joined(a.head + b.head)
            if not left.closed:
                return ChunkMap(left.head, True, b.tokens, b.tail)
            return ChunkMap(left.head, True, left.tokens + self.count([left.tail]) + b.tokens, b.tail)
        middle = self.joined(a.tail + b.head)
        if not b.closed:
            if not middle.closed:
                return ChunkMap(a.head, True, a.tokens, middle.head)
            return ChunkMap(a.head, True, a.tokens + self.count([middle.head]) + middle.tokens, middle.tail)
        ends = [middle.head, middle.tail] if middle.closed else [middle.head]
        return ChunkMap(a.head, True, a.tokens + self.count(ends) + middle.tokens + b.tokens, b.tail)

    def joined(self, text: str) -> ChunkMap:
        return self.chunk_map(text)

    def tokens(self, text: str, chunk: int = CHUNK) -> int:
        if not text:
            return 0
        text = META + text.replace(" ", META)
        if len(text) <= chunk:
            return self.count(self.model.unit.findall(text))
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[len(maps) - len(maps) % 2 :]
        whole = maps[0]
        return self.count([whole.head, whole.tail] if whole.closed else [whole.head]) + whole.tokens


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit. model_path is read where a task runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = CountTransducer(model_path or public_model_path())
        for batch in batches:
            texts = batch.column("_text").fill_null("")
            counts = pa.array([machine.tokens(t.as_py()) for t in texts], pa.int64())
            yield pa.record_batch({"_id": batch.column("_id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                                   "n_tokens": counts, "over_limit": pc.greater(counts, limit)})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("_id", id_col)
