"""Exact Jaccard join of documents on word shingles, in the metric space of their sets.

Two documents link when the Jaccard similarity of their shingle sets reaches a threshold, that is when
their distance 1 - J is at most eps. The result is each document's set size and its component.

1. Seeds. Texts about nothing in common all lie at distance 1 from each other and from any pivot, where
   the triangle inequality tells nothing. So documents are first gathered around seeds: a set is cut
   by hash into more slices than two linked sets of its size can differ in, so they agree on at least
   as many slices as there are more (see Slices), less those that are empty. Signatures of slices are counted, and those that
   several documents have go back to these. A set whose links share t of its signatures keeps all but its t - 1
   most frequent ones, so common phrases hardly chain documents. What is equal of the kept signatures is a
   meeting, named by the least id. Only a spanning forest of the meetings leaves a task, never pairs. Their components
   are the outer regions; every link lies within one, and documents that meet nobody are done without their
   sets being sent. Of equal sets (128-bit hashes of them) one document stands for the others from here on.
2. Pivots. A region of more than LEAF documents is split by pivots: each document goes to its nearest
   pivot's Voronoi region, and also to each other pivot p with d(x, p) <= d(x, nearest) + 2 eps. By the
   triangle inequality two linked documents then meet in the region of either one's nearest pivot.
   Links to pivots are settled on the way, and a region whose documents are already connected is done.
3. Recursion ends at LEAF documents, or where pivots don't separate; these are compared exactly.

A region of at most MAX_REGION shingles is split within one task. Common phrases may still chain
unrelated documents to a larger one, and these pivots don't separate. So a larger one is first seeded
again: shingles are counted in the region and ordered from rare to common. Linked sets share one
of the least shingles of each, as many as a linked set may lack and one more (prefix filter). Shingles that one
document alone has take their places there and meet nobody. What meets by the others is a new region.
One that is still larger is split by Spark: its documents are dealt to blocks, and each block meets the region's pivots. A region that is connected by
then is done; where few documents are outside the largest component, these are compared with all others;
otherwise the Voronoi regions are new regions. What is left after LEVELS rounds is joined block by block.
Equal sets are compared once. Nothing is capped.

Slices: if linked sets of a size class differ in at most D elements, then of D + 1 + s slices at least
s + 1 are equal, and one of them is not empty unless both sets have more than s empty slices. Sets with
more than s empty ones are cut again with another salt, until they have not, so empty slices are never
compared. Where sets are too small for that, every element is a signature of its own.

Defined results: null and wordless texts have no shingles and link with nothing; a text shorter than a
shingle is one shingle; repeated rows each get a row; rows that share an id count as one node with the
links of each; a row with a null id links with nothing and has a null component; extra columns are not
read; an empty table gives an empty result. Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.llm.components import components
from siftmark.llm.packets import Gather, empty_packets, pack, part_count, reduce_parts, schema
from siftmark.llm.quality_rules import id_filter, likely
from siftmark.llm.textbatch import U64, TextSlice, chain, mix, slices
from siftmark.sources.scratch import written

SHINGLE = 5
PERCENT = 80
LEAF = 48
PIVOTS = 8
#: Shingles of a region that one task takes, and documents of a block of a larger region.
MAX_REGION = 12_000_000
BLOCK = 4096
LEVELS = 3
SALTS = 32
SLACK = 1e-9
#: The bits above these of a signature are its group's code; the code of whole sets.
CODE = U64(57)
WHOLE = 2 * (SALTS + 1)
#: Makes the second hash of a whole set.
SECOND = U64(0x8CB92BA72F3D8DD7)

SIGNATURE = {"sig": np.uint64, "doc": np.int64}
#: Kinds of rows of `seed_meetings`: a document and the size of its set (NO_ID: the id is null), a meeting, a document with an equal set and
#: the one that stands for it, a signature (`more` is a second hash of a whole set), a group and how many of its signatures a link shares.
DOC, EDGE, NO_ID, COPY, SIGNED, GROUP = range(6)
MET = SIGNATURE | {"kind": np.int8}
SIGNATURES = MET | {"more": np.uint64}
SHARED = MET | {"n": np.int32}
#: A shingle of a document with the number of documents that have it; 0: `sig` is the document's allowance (`allowance`).
COUNTED = SIGNATURE | {"n": np.int32}
#: Bits of a shingle's hash that are not sent when shingles are counted: equal rests only make a region larger.
UNSENT = 24
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(part: TextSlice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and the edges between texts."""
    words = part.word_hashes()
    grams, fit = chain(words, n), part.fits(n)
    values, docs = [grams[fit]], [part.doc[: len(grams)][fit]]
    for size in range(1, n):
        short = np.flatnonzero(part.n_words == size)
        if len(short):
            values.append(chain(words, size)[part.first[short]])
            docs.append(short)
    values, docs = np.concatenate(values), np.concatenate(docs)
    order = np.lexsort((values, docs))
    values, docs = values[order], docs[order]
    new = np.append(True, (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])) if len(values) else np.zeros(0, bool)
    values, docs = values[new], docs[new]
    return values, np.searchsorted(docs, np.arange(part.n + 1))


def lowered(part: TextSlice) -> TextSlice:
    part.data = LOWER[part.data]
    return part


@lru_cache(maxsize=8)
def size_classes(percent: int, limit: int) -> np.ndarray:
    """First sizes of the classes; linked sets are in the same class or in neighbouring ones."""
    out = [1]
    while out[-1] <= limit:
        out.append(100 * out[-1] // percent + 1)
    return np.array(out)


@lru_cache(maxsize=4096)
def slice_count(low: int, high: int, percent: int) -> tuple[int, int]:
    """Slices for pairs whose smaller set has low..high-1 elements, and empty slices to put up with.

    No slices: the sets are too small for them, and each element is a signature.
    """
    small = high - 1
    large = 100 * small // percent
    apart = max((100 - percent) * (small + large) // (100 + percent), large - small)
    slack = 0
    for _ in range(50):
        empty = (apart + 1 + slack) * np.exp(-low / (apart + 1 + slack))
        wanted = int(np.ceil(empty + 2 * np.sqrt(empty))) if empty > 0.3 else 0
        if wanted <= slack or wanted > apart + 8:
            break
        slack = wanted
    count = apart + 1 + slack
    return (0, 0) if count > 1 and low < 2 * count else (count, slack)


def slice_signatures(values: np.ndarray, edges: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the non-empty slices of each set, for its size class and the one below."""
    return grouped_signatures(values, edges, percent)[:2]


def coded(sigs: np.ndarray, codes: np.ndarray | int) -> np.ndarray:
    """Signatures with the code of their group in the high bits."""
    return (sigs >> U64(64 - CODE)) | (np.asarray(codes).astype(U64) << CODE)


def grouped_signatures(values: np.ndarray, edges: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Signatures and their sets; and of each group of signatures of a set: set, code, signatures that a linked set shares.

    A group is what one salt cuts at one size class. A linked set shares so many of the signatures of at least one
    group with the same code, as its empty slices can be no more than that group's among the equal ones.
    """
    sizes = np.diff(edges)
    classes = size_classes(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(classes, sizes, side="right") - 1
    sigs, docs = [], []
    groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for shift in (0, 1):
        level = own - shift
        todo = np.flatnonzero((sizes > 0) & (level >= 0))
        plan = [slice_count(int(classes[k]), int(classes[k + 1]), percent) for k in range(len(classes) - 1)]
        count = np.array([p[0] for p in plan] + [1])
        slack = np.array([p[1] for p in plan] + [0])
        todo = todo[count[level[todo]] != 1]  # one slice: only equal sets, which the whole set's signature finds
        single, todo, salt = todo[count[level[todo]] == 0], todo[count[level[todo]] > 1], 0
        while len(todo) and salt < SALTS:
            take = np.repeat(todo, sizes[todo])
            at = np.concatenate([[0], np.cumsum(sizes[todo])])[:-1]
            index = np.arange(len(take)) - np.repeat(at - edges[todo], sizes[todo])
            mixed = mix(values[index] + U64(0x632BE59BD9B4E019 * (salt + 1) & (1 << 64) - 1))
            cut = ((mixed >> U64(32)) * count[level[take]].astype(U64)) >> U64(32)
            local = np.repeat(np.arange(len(todo)), sizes[todo])
            base = np.concatenate([[0], np.cumsum(count[level[todo]])])
            cell = base[local] + cut.astype(np.int64)
            order = np.argsort(cell, kind="stable")
            sorted_cells = cell[order]
            first = np.flatnonzero(np.append(True, sorted_cells[1:] != sorted_cells[:-1]))
            sums = np.add.reduceat(mix(mixed[order]), first)
            cells = sorted_cells[first]
            of = np.searchsorted(base, cells, side="right") - 1
            key = (cells - base[of]).astype(U64) * U64(0x9FB21C651E98DF25) + level[todo[of]].astype(U64) * U64(0xD1B54A32D192ED03)
            code = (level[todo] % 2) * (SALTS + 1) + salt
            sigs.append(coded(mix(sums + mix(key + U64(salt))), code[of]))
            docs.append(todo[of])
            empty = count[level[todo]] - np.bincount(of, minlength=len(todo))
            spare = slack[level[todo]] - empty
            groups.append((todo, code, np.maximum(spare, 0) + 1))
            todo = todo[spare < 0]
            salt += 1
        single = np.concatenate([single, todo])
        code = (level[single] % 2) * (SALTS + 1) + SALTS
        groups.append((single, code, -(-percent * sizes[single] // 100)))
        for i, c in zip(single, code, strict=True):
            sigs.append(coded(mix(values[edges[i] : edges[i + 1]] + U64(level[i] + 2)), c))
            docs.append(np.full(sizes[i], i))
    full = np.flatnonzero(sizes > 0)
    if len(full):
        sigs.append(coded(mix(np.add.reduceat(mix(values), edges[:-1][full]) + U64(1)), WHOLE))
        docs.append(full)
    none = np.zeros(0, np.int64)
    return (np.concatenate(sigs) if sigs else np.zeros(0, U64), np.concatenate([none, *docs]),
            *(np.concatenate([none, *x]) for x in zip(*groups, strict=True)))


def meeting_edges(sigs: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the documents that share a signature."""
    order = np.lexsort((docs, sigs))
    s, d = sigs[order], docs[order]
    first = np.append(True, s[1:] != s[:-1]) if len(s) else np.zeros(0, bool)
    seed = d[np.flatnonzero(first)][np.cumsum(first) - 1] if len(s) else d
    pairs = np.unique(np.stack([seed[seed != d], d[seed != d]]), axis=1)
    ids, ends = np.unique(pairs, return_inverse=True)
    root, a, b = np.arange(len(ids)), *ends.reshape(2, -1)
    while True:  # hook each root to the least root that it meets, then shorten
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(ids))
    return ids[root[moved]], ids[moved]


class Table:
    """Elements of some sets as numbers, for counting what one of them shares with the others.

    Elements that only one set has, and those that all have, are not stored: they add nothing or one.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        keep = (count[number] > 1) & (count[number] < len(sets))
        self.common = int((count == len(sets)).sum()) if len(sets) > 1 else 0
        self.number, self.owner = number[keep].astype(np.int32), owner[keep].astype(np.int32)
        self.start = np.searchsorted(self.owner, np.arange(len(sets) + 1))
        self.mark = np.zeros(len(count), bool)

    def shared(self, k: int, others: np.ndarray) -> np.ndarray:
        """Elements that the k-th set shares with each of the others."""
        own = self.number[self.start[k] : self.start[k + 1]]
        self.mark[own] = True
        if 4 * len(others) > len(self.sizes):
            counts = np.bincount(self.owner[self.mark[self.number]], minlength=len(self.sizes))[others]
        else:
            counts = np.array([np.count_nonzero(self.mark[self.number[self.start[i] : self.start[i + 1]]]) for i in others], np.int64)
        self.mark[own] = False
        return np.where(others == k, self.sizes[k], counts + self.common)


class Sets:
    """Sets of a region, with a component label for each."""

    def __init__(self, blobs: list[bytes], percent: int):
        self.sets = [np.frombuffer(b, U64) for b in blobs]
        self.percent, self.eps = percent, 1 - percent / 100
        self.label = np.arange(len(blobs))

    def link(self, members: np.ndarray) -> None:
        labels = np.unique(self.label[members])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def against(self, table: Table, k: int, members: np.ndarray) -> np.ndarray:
        """Distances of all members to the k-th; those that reach the threshold (in whole numbers) are linked."""
        shared = table.shared(k, np.arange(len(members)))
        union = table.sizes[k] + table.sizes - shared
        self.link(members[100 * shared >= self.percent * union])
        return 1 - shared / union

    def compare(self, table: Table, members: np.ndarray, distances: list[np.ndarray]) -> None:
        """Members in turn against those they could still link with.

        These are the ones of another component whose size fits and which no pivot's distance rules out:
        linked documents differ by eps at most in their distance to any pivot. Central documents come
        first, as they link most of a family, then members of small components; when the largest one's
        turn comes, all others have been compared.
        """
        sizes, done = table.sizes, np.zeros(len(members), bool)
        centre = np.argsort(np.sum(distances, axis=0), kind="stable")[:PIVOTS] if distances else []
        for k in centre:
            self.against(table, int(k), members)
            done[k] = True
        counts = np.bincount(self.label[members], minlength=len(self.label))[self.label[members]]
        for k in np.argsort(counts, kind="stable"):
            near = (self.label[members] != self.label[members[k]]) & ~done
            near &= 100 * np.minimum(sizes[k], sizes) >= self.percent * np.maximum(sizes[k], sizes)
            for d in distances:
                near &= np.abs(d - d[k]) <= self.eps + SLACK
            others = np.flatnonzero(near)
            if len(others) and not done[k]:
                shared = table.shared(int(k), others)
                linked = 100 * shared >= self.percent * (sizes[k] + sizes[others] - shared)
                self.link(members[np.append(others[linked], k)])
            done[k] = True

    def join(self, members: np.ndarray) -> None:
        """Find all links between the members, as far as they connect."""
        if len(members) < 2 or (self.label[members] == self.label[members[0]]).all():
            return
        table = Table([self.sets[i] for i in members])
        if len(members) <= LEAF:
            self.compare(table, members, [])
            return
        pivots, distances = [0], []
        while True:  # the next pivot is the document farthest from those so far
            distances.append(self.against(table, pivots[-1], members))
            nearest = np.min(distances, axis=0)
            if len(pivots) == PIVOTS or nearest.max() <= 0:
                break
            pivots.append(int(nearest.argmax()))
        regions = [members[d <= nearest + 2 * self.eps + SLACK] for d in distances]
        if max(map(len, regions)) > 0.8 * len(members):
            self.compare(table, members, distances)
            return
        del table
        for region in regions:
            self.join(region)


def join_regions(regions: np.ndarray, ids: np.ndarray, blobs: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (least id of a component, id) in each of the regions."""
    order = np.lexsort((ids, regions))
    out_a, out_b = [], []
    for rows in np.split(order, np.flatnonzero(np.diff(regions[order])) + 1) if len(order) else []:
        _, lead, copy_of = np.unique([blobs[i] for i in rows], return_index=True, return_inverse=True)
        sets = Sets([blobs[rows[i]] for i in lead], percent)  # equal sets are compared once
        sets.join(np.arange(len(lead)))
        label = sets.label[copy_of]
        first = np.full(len(lead), len(rows))
        np.minimum.at(first, label, np.arange(len(rows)))
        first = first[label]
        moved = first != np.arange(len(rows))
        out_a.append(ids[rows[first[moved]]])
        out_b.append(ids[rows[moved]])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def copies_of(sigs: np.ndarray, more: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of documents with equal sets (128 bits): the first by `docs` that stands for the others, and each of these."""
    order = np.lexsort((docs, more, sigs))
    s, m = sigs[order], more[order]
    first = np.append(True, (s[1:] != s[:-1]) | (m[1:] != m[:-1])) if len(s) else np.zeros(0, bool)
    return order[np.flatnonzero(first)[np.cumsum(first) - 1]][~first], order[~first]


def shared_signatures(x: dict[str, np.ndarray], count: int) -> Iterator[pa.RecordBatch]:
    """Packets by document of the signatures that several documents have, with the number of these; of equal sets; and of all other rows."""
    rest, whole = x["kind"] != SIGNED, x["sig"] >> CODE == WHOLE
    whole &= ~rest
    lead, copy = copies_of(x["sig"][whole], x["more"][whole], x["doc"][whole])
    a, b = x["doc"][whole][lead], x["doc"][whole][copy]
    a, b = a[a != b], b[a != b]
    sliced = ~rest & ~whole
    order = np.lexsort((x["doc"][sliced], x["sig"][sliced]))
    sig, doc, n = x["sig"][sliced][order], x["doc"][sliced][order], np.zeros(0, np.int64)
    if len(sig):
        first = np.append(True, sig[1:] != sig[:-1])
        new = first | np.append(True, doc[1:] != doc[:-1])
        first = np.flatnonzero(first)
        n = np.repeat(np.add.reduceat(new, first, dtype=np.int64), np.diff(np.append(first, len(sig))))
        sig, doc, n = sig[n > 1], doc[n > 1], n[n > 1]
    kind = np.repeat(np.array([COPY, SIGNED], np.int8), [len(a), len(sig)])
    doc = np.concatenate([x["doc"][rest], b, doc])
    yield from pack({"sig": np.concatenate([x["sig"][rest], a.view(U64), sig]), "doc": doc, "kind": np.append(x["kind"][rest], kind),
                     "n": np.append(np.zeros(rest.sum() + len(a)), n).astype(np.int32)}, np.mod(doc, count), count)


def rare_signatures(x: dict[str, np.ndarray], count: int) -> Iterator[pa.RecordBatch]:
    """Packets by signature of what each group keeps of its shared signatures; and of documents and copies.

    Of a group whose links share t of its signatures, all but the t - 1 most frequent are kept: with an order that is the same for
    all, the least that is shared with a link is among them. A copy keeps none, as another document stands for it.
    Where rows share an id, their groups can't be told apart, and all are kept.
    """
    rest = x["kind"] < SIGNED
    sig, doc, n, head = x["sig"][~rest], x["doc"][~rest], x["n"][~rest], x["kind"][~rest] == GROUP
    code = (sig >> CODE).astype(np.int8)
    order = np.lexsort((sig, n, code, doc))  # a group's own row has no number of documents and so stands first
    sig, doc, code, head = sig[order], doc[order], code[order], head[order]
    group = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (code[1:] != code[:-1]))) - 1 if len(sig) else np.zeros(0, np.int64)
    wanted = np.ones(len(sig), np.int64)
    wanted[group[head]] = (sig[head] & ((U64(1) << CODE) - U64(1))).astype(np.int64)
    sig, doc, group = sig[~head], doc[~head], group[~head]
    shared = np.bincount(group, minlength=len(wanted))
    place = np.arange(len(sig)) - (np.cumsum(shared) - shared)[group]
    ids, rows = np.unique(x["doc"][x["kind"] == DOC], return_counts=True)
    keep = (place <= (shared - wanted)[group]) & ~np.isin(doc, x["doc"][x["kind"] == COPY])
    keep |= np.isin(doc, ids[rows > 1])
    sig, doc = sig[keep], doc[keep]
    yield from pack({"sig": np.append(x["sig"][rest], sig), "doc": np.append(x["doc"][rest], doc), "kind": np.append(x["kind"][rest], np.full(len(sig), SIGNED, np.int8))},
                    np.append(np.mod(x["doc"][rest], count), (sig % U64(count)).astype(np.int64)), count)


def seed_meetings(docs: DataFrame, shingle: int, percent: int, count: int) -> DataFrame:
    """Rows (kind, a, b): a document and the size of its set, an edge of a meeting, a document and its copy.

    Three shuffles: all signatures are counted, those that several documents have go back to these, and what they keep meets.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = Gather(SIGNATURES, count)
        none = lambda x: np.zeros(len(x), np.uint64)
        for batch in batches:
            known = np.array(batch.column("_id").is_valid())
            ids = batch.column("_id").fill_null(0).to_numpy()
            for part in slices(batch.column("_text")):
                values, edges = shingle_sets(lowered(part), shingle)
                here = ids[part.low : part.low + part.n]
                sizes = np.diff(edges).astype(np.uint64)
                valid = known[part.low : part.low + part.n]
                yield from gather.add(np.mod(here, count), sig=sizes, doc=here, kind=np.where(valid, DOC, NO_ID), more=none(here))
                sigs, of, *groups = grouped_signatures(values, edges, percent)
                more = none(sigs)
                whole = np.flatnonzero(sigs >> CODE == WHOLE)  # one for each set that is not empty, in order
                if len(whole):
                    more[whole] = np.add.reduceat(mix(values ^ SECOND), edges[:-1][of[whole]])
                whole = whole[valid[of[whole]]]
                lead, copy = (of[whole[k]] for k in copies_of(sigs[whole], more[whole], here[of[whole]]))
                yield from gather.add(np.mod(here[copy], count), sig=here[lead].view(U64), doc=here[copy], kind=np.full(len(copy), COPY), more=none(copy))
                sent = valid.copy()
                sent[copy] = False
                sigs, of, more = (y[sent[of]] for y in (sigs, of, more))
                yield from gather.add((sigs % U64(count)).astype(np.int32), sig=sigs, doc=here[of], kind=np.full(len(sigs), SIGNED), more=more)
                of, code, wanted = (g[sent[groups[0]] & (groups[2] > 1)] for g in groups)
                head = wanted.astype(U64) | (code.astype(U64) << CODE)
                yield from gather.add(np.mod(here[of], count), sig=head, doc=here[of], kind=np.full(len(of), GROUP), more=none(of))
        yield from gather.flush()

    def meet(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        signed = x["kind"] == SIGNED
        a, b = meeting_edges(x["sig"][signed], x["doc"][signed])
        doc, copy = (x["kind"] == DOC) | (x["kind"] == NO_ID), x["kind"] == COPY
        yield pa.record_batch({
            "kind": np.concatenate([x["kind"][doc], x["kind"][copy], np.full(len(a), EDGE, np.int8)]).astype(np.int32),
            "a": np.concatenate([x["doc"][doc], x["sig"][copy].view(np.int64), a]),
            "b": np.concatenate([x["sig"][doc].view(np.int64), x["doc"][copy], b])})

    shared = reduce_parts(docs.mapInArrow(scan, schema(SIGNATURES)), SIGNATURES, lambda x: shared_signatures(x, count), schema(SHARED), lambda: empty_packets(SHARED))
    rare = reduce_parts(shared, SHARED, lambda x: rare_signatures(x, count), schema(MET), lambda: empty_packets(MET))
    empty = lambda: pa.table({"kind": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    return reduce_parts(rare, MET, meet, "kind int, a long, b long", empty)


def allowance(size: int, keys: int, percent: int) -> int:
    """Length of the prefix of a set, less all its keys: with the number of shared keys added, how many of these are in it.

    A set's links share at least percent % of it, so the least shared element is among the first
    size - ceil(percent * size / 100) + 1. Keys that no other set has come first in the order.
    """
    return size + (-percent * size // 100) + 1 - keys


def counted_shingles(x: dict[str, np.ndarray], count: int) -> Iterator[pa.RecordBatch]:
    """Packets by document of the shingles that several documents have, and of the allowances."""
    own = x["n"] == 0
    order = np.lexsort((x["doc"][~own], x["sig"][~own]))
    sig, doc = x["sig"][~own][order], x["doc"][~own][order]
    if len(sig):
        new = np.append(True, (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1]))  # rows that share an id are one document
        sig, doc = sig[new], doc[new]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        times = np.diff(np.append(first, len(sig)))
        times = np.repeat(times, times)
        sig, doc, times = sig[times > 1], doc[times > 1], times[times > 1]
    else:
        times = np.zeros(0, np.int32)
    doc = np.concatenate([x["doc"][own], doc])
    yield from pack({"sig": np.concatenate([x["sig"][own], sig]), "doc": doc,
                     "n": np.concatenate([x["n"][own], times]).astype(np.int32)}, np.mod(doc, count), count)


def prefix_signatures(x: dict[str, np.ndarray], count: int) -> Iterator[pa.RecordBatch]:
    """Packets by shingle of the shared shingles in the prefix of each document.

    Where rows share an id, their shingles can't be told apart, and all are sent.
    """
    own = x["n"] == 0
    ids, at, rows = np.unique(x["doc"][own], return_inverse=True, return_counts=True)
    allowed = np.zeros(len(ids), np.int64)
    np.add.at(allowed, at, x["sig"][own].view(np.int64))
    sig, doc = x["sig"][~own], x["doc"][~own]
    order = np.lexsort((sig, x["n"][~own], doc))
    sig, doc = sig[order], doc[order]
    of = np.searchsorted(ids, doc)
    shared = np.bincount(of, minlength=len(ids))
    place = np.arange(len(doc)) - (np.cumsum(shared) - shared)[of]
    keep = (place < (allowed + shared)[of]) | (rows[of] > 1)
    yield from pack({"sig": sig[keep], "doc": doc[keep]}, (sig[keep] % U64(count)).astype(np.int32), count)


def prefix_meetings(nodes: DataFrame, percent: int, count: int) -> DataFrame:
    """Edges (a, b) of the documents (region, _id, set) of a region that share a shingle of their prefixes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = Gather(COUNTED, count)
        for batch in batches:
            ids, regions = batch.column("_id").to_numpy(), batch.column("region").to_numpy()
            for doc, region, blob in zip(ids, mix(regions.view(U64)), batch.column("set"), strict=True):
                values = np.frombuffer(blob.as_buffer(), U64)
                sig = np.unique(mix(values ^ region) >> U64(UNSENT))
                own = np.array([allowance(len(values), len(sig), percent)], np.int64).view(U64)
                yield from gather.add((sig % U64(count)).astype(np.int32), sig=sig, doc=np.full(len(sig), doc), n=np.ones(len(sig)))
                yield from gather.add(np.array([doc % count]), sig=own, doc=np.array([doc]), n=np.zeros(1))
        yield from gather.flush()

    def meet(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b = meeting_edges(x["sig"], x["doc"])
        yield pa.record_batch({"a": a, "b": b})

    counted = reduce_parts(nodes.select("region", "_id", "set").mapInArrow(scan, schema(COUNTED)), COUNTED,
                           lambda x: counted_shingles(x, count), schema(COUNTED), lambda: empty_packets(COUNTED))
    kept = reduce_parts(counted, COUNTED, lambda x: prefix_signatures(x, count), schema(SIGNATURE), lambda: empty_packets(SIGNATURE))
    empty = lambda: pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    return reduce_parts(kept, SIGNATURE, meet, "a long, b long", empty)


def with_sets(docs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """(region, _id, set) of the documents that have met others. Only these and a filter's few wrong hits are shuffled."""
    docs = likely(docs, id_filter(members.select(F.col("node").alias("_id"))))
    # a share of all texts, so a shuffle at every size; the hint keeps small trials to the plan of large runs
    rows = docs.join(members.withColumnsRenamed({"node": "_id", "component": "region"}).hint("merge"), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs: list[bytes] = []
            for part in slices(batch.column("_text")):
                values, edges = shingle_sets(lowered(part), shingle)
                blobs += [values[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)]
            full = pa.array([bool(b) for b in blobs], pa.bool_())
            yield pa.record_batch({"region": batch.column("region"), "_id": batch.column("_id"),
                                   "set": pa.array(blobs, pa.binary())}).filter(full)

    return rows.select("region", "_id", "_text").mapInArrow(run, "region long, _id long, set binary")


def group_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Links within the regions of each task group, as edges (a, b)."""
    def run(table: pa.Table) -> pa.Table:
        a, b = join_regions(table["region"].to_numpy(), table["_id"].to_numpy(), table["set"].to_pylist(), percent)
        return pa.table({"a": a, "b": b})

    return rows.groupBy("task").applyInArrow(run, "a long, b long")


def meet_pivots(rows: DataFrame, pivots: DataFrame, percent: int, block: int, split: bool) -> DataFrame:
    """Rows (kind, a, b) of documents (region, size, _id, set) and pivots of their regions.

    The documents of a region are dealt to blocks, and each block meets all of the region's pivots. Kind 1
    is a link (pivot, id); kind 0, only with `split`, is a Voronoi region and an id in it.
    """
    blocks = F.ceil(F.col("size") / block).cast("long")
    dealt = rows.withColumn("task", F.pmod(F.xxhash64(F.col("_id"), F.lit(7)), blocks))
    pivots = pivots.select("region", "_id", "set", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("task"))
    pivots = pivots.select(*(F.col(c).alias(c) for c in pivots.columns))  # both sides may come from one frame
    eps = 1 - percent / 100

    def run(nodes: pa.Table, at: pa.Table) -> pa.Table:
        m, k = nodes.num_rows, at.num_rows
        ids, pivot_ids, region = nodes["_id"].to_numpy(), at["_id"].to_numpy(), nodes["region"].to_numpy()
        kinds, a, b = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if m and not k and split:  # no pivot: the region stays whole
            kinds, a, b = [np.zeros(m, np.int32)], [region], [ids]
        elif m and k:
            table = Table([np.frombuffer(x, U64) for x in at["set"].to_pylist() + nodes["set"].to_pylist()])
            members = np.arange(k, k + m)
            nearest = np.full(m, np.inf)
            found = []
            for p in range(k):
                shared = table.shared(p, members)
                union = table.sizes[p] + table.sizes[members] - shared
                d, linked = 1 - shared / union, 100 * shared >= percent * union
                kinds.append(np.ones(int(linked.sum()), np.int32))
                a.append(np.full(int(linked.sum()), pivot_ids[p]))
                b.append(ids[linked])
                if split:
                    found.append(d)
                    nearest = np.minimum(nearest, d)
            for p, d in enumerate(found):
                near = d <= nearest + 2 * eps + SLACK
                name = mix(np.array([region[0], pivot_ids[p]], np.int64).view(U64) * np.array([3, 5], U64)).sum()
                kinds.append(np.zeros(int(near.sum()), np.int32))
                a.append(np.full(int(near.sum()), name, U64).view(np.int64))
                b.append(ids[near])
        return pa.table({"kind": np.concatenate(kinds), "a": np.concatenate(a), "b": np.concatenate(b)})

    keys = ["region", "task"]
    return dealt.groupBy(*keys).cogroup(pivots.groupBy(*keys)).applyInArrow(run, "kind int, a long, b long")


def block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Each region in blocks; every two blocks of a region are a task group."""
    blocks = F.greatest(F.lit(2), F.ceil(F.col("size") / (block // 2))).cast("long")
    own = rows.withColumn("n", blocks).withColumn("own", F.pmod(F.xxhash64(F.col("_id"), F.lit(11)), F.col("n")))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).where("own <> other")
    return pairs.withColumn("task", F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")))


def split_regions(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Edges of regions (region, _id) too large for a task. sets: (_id, set), stored.

    In a round some documents of each region are its pivots and meet all the others. A region that this
    connects is done. If few documents are left outside its largest component, these become pivots in
    turn: then all their links are known, and the region is done. Otherwise it is split by its pivots.
    """
    edges = None
    for level in range(LEVELS):
        members = written(members.join(members.groupBy("region").agg(F.count("*").alias("size")), "region"))
        rows = members.join(sets, "_id")
        chosen = F.pmod(F.xxhash64("_id"), F.ceil(F.col("size") / PIVOTS)) == 0
        links = written(meet_pivots(rows, rows.where(chosen), percent, block, False))
        found = links.select("a", "b")
        edges = found if edges is None else edges.unionByName(found)
        known = components(edges)
        label = members.join(known.withColumnRenamed("node", "_id"), "_id", "left").withColumn("label", F.coalesce("component", "_id"))
        label = written(label.select("region", "size", "_id", "label"))
        largest = label.groupBy("region", "label").agg(F.count("*").alias("n"), F.max("size").alias("size"))
        largest = largest.groupBy("region").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.max("size").alias("size"), F.max("n").alias("n"))
        state = written(largest.withColumn("outside", F.col("size") - F.col("n")).where("outside > 0").drop("size", "n"))
        if state.isEmpty():
            return edges
        open_ = label.join(state, "region")
        few = open_.where(F.col("outside") <= F.lit(block))
        stragglers = few.where("label <> most").select("region", "size", "_id")
        edges = edges.unionByName(written(meet_pivots(few.select("region", "size", "_id").join(sets, "_id"), stragglers.join(sets, "_id"),
                                                      percent, block, False)).select("a", "b"))
        many = open_.where(F.col("outside") > block).select("region", "size", "_id").join(sets, "_id")
        members = written(meet_pivots(many, many.where(chosen), percent, block, True).where("kind = 0")
                          .select(F.col("a").alias("region"), F.col("b").alias("_id")))
        if members.isEmpty():
            return edges
    sized = members.join(members.groupBy("region").agg(F.count("*").alias("size")), "region")
    return edges.unionByName(group_edges(block_pairs(sized.join(sets, "_id"), block), percent))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, max_region: int = MAX_REGION, block: int = BLOCK) -> DataFrame:
    """Per row: id, n_shingles, component_id (least id reachable by links).

    Runs jobs while it is called: meetings, components of regions and their sizes are written to the
    shared folder.
    """
    spark = docs.sparkSession
    count = part_count(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    met = written(seed_meetings(rows, shingle, percent, count))
    regions = components(met.where(F.col("kind") == EDGE).select("a", "b"))
    widths = met.where(F.col("kind") == DOC).groupBy(F.col("a").alias("node")).agg(F.max("b").alias("n"))
    sizes = regions.join(widths, "node").groupBy("component").agg(F.sum("n").alias("n"))
    large = written(sizes.where(F.col("n") > max_region).select("component"))
    deal = F.pmod(F.xxhash64("region"), F.lit(count)).cast("long")
    if large.isEmpty():
        edges = group_edges(with_sets(rows, regions, shingle).withColumn("task", deal), percent)
    else:
        small, rest = (regions.join(large, "component", how) for how in ("left_anti", "left_semi"))
        edges = group_edges(with_sets(rows, small, shingle).withColumn("task", deal), percent)
        sets = written(with_sets(rows, rest, shingle))
        alike = sets.groupBy(F.sha2("set", 256).alias("key"), "region").agg(F.min("_id").alias("first"))
        copies = written(sets.select(F.sha2("set", 256).alias("key"), "region", "_id").join(alike, ["key", "region"]).where("_id <> first"))
        edges = edges.unionByName(copies.select(F.col("first").alias("a"), F.col("_id").alias("b")))
        nodes = sets.join(copies.select("_id"), "_id", "left_anti")
        closer = components(prefix_meetings(nodes, percent, count)).withColumnsRenamed({"node": "_id", "component": "region"})
        sizes = closer.join(widths.withColumnRenamed("node", "_id"), "_id").groupBy("region").agg(F.sum("n").alias("n"))
        large = written(sizes.where(F.col("n") > max_region).select("region"))
        small, rest = (closer.join(large, "region", how) for how in ("left_anti", "left_semi"))
        sets = nodes.select("_id", "set")
        edges = edges.unionByName(group_edges(sets.join(small, "_id").withColumn("task", deal), percent))
        if not large.isEmpty():
            edges = edges.unionByName(split_regions(rest, sets, percent, block))
    found = components(edges.unionByName(met.where(F.col("kind") == COPY).select("a", "b")))
    sized_docs = met.where(F.col("kind").isin(DOC, NO_ID)).select(F.when(F.col("kind") == DOC, F.col("a")).alias("_id"), F.col("b").alias("n_shingles"))
    out = sized_docs.join(found.withColumnsRenamed({"node": "_id"}), "_id", "left")
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("component", "_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows whose document has the least id of its component, with all their columns.

    Rows with a null id stay. Of rows that share an id, those of a kept id stay.
    """
    found = jaccard_components(docs, id_col, text_col, **options)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
