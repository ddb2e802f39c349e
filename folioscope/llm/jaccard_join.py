"""N-gram Jaccard join: a size-aware heavy-light join of documents on word shingles.

Two documents link when the Jaccard similarity of their shingle sets is at least 0.8. The join follows
the size-aware scheme of Deng, Tao and Li (2018), with prefixes in place of whole sets, since a Jaccard
threshold asks for an overlap that grows with the set:

* all shingles are put in one order, frequent ones last. Two sets that link share at least k shingles
  among the first ``size - ceil(0.8 size) + k`` of each;
* *light* sets (fewer shingles than a boundary) enumerate the 2-subsets of that prefix with k = 2;
* *heavy* sets put the single shingles of their prefix (k = 1) into inverted lists, which are scanned.
  Light sets of at least 0.8 times the boundary stand there as well, to meet heavy ones;
* the boundary is where subsets begin to cost more than the scanned lists, from measured totals per size.

Keys are packed and dealt by hash to shards. A shard scans its lists and subset groups, holds each pair in
them against sizes and sketches (counts of shingles by hash, whose common part bounds the overlap from above)
and returns a spanning forest of the pairs that can still link. The forest's components are the only places
where links can be. A component is then scanned in tiles of bounded size: each tile pair counts exact overlaps
over its inverted lists and returns a spanning forest of its links. So a large group of near copies costs
reading, never rows, and no pair list exists. Sets with the same shingles are one set from the start.

Defined results: a null, empty or blank text has no shingles and links with nothing. A text of fewer than
five words is one shingle. Rows that share a doc_id are one node of the graph; a row without doc_id is its own
component, with a null id. Extra columns are ignored. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.graph import components
from folioscope.llm.stages import stage
from folioscope.llm.words import Texts, counted, mixed, shingles

SLICE_BYTES = 4 << 20
FREQUENT_SHINGLES = 1 << 16  # shingles with a known rank; the order of all others is that of their hashes
FREQUENT_LOCALLY = 3  # documents of one slice
TILE_SHINGLES = 1 << 19
SHARD_KEYS = 1 << 21
SCAN_COST = 1 / 500  # of counting one shingle of one partner, against moving one key
SIZES = [2 ** (k / 2) for k in range(0, 62)]  # size classes of the cost totals

_SET, _SHINGLE, _COST = 0, 1, 2


def _prefix(size: int, k: int) -> int:
    return min(size, size - -(-4 * size // 5) + k)


def _identity(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a sorted set."""
    place = np.arange(1, len(s) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    a = mixed(np.array([np.sum(mixed(s + place) * place, dtype=np.uint64) + np.uint64(len(s))]))
    b = mixed(np.array([np.bitwise_xor.reduce(mixed(s * np.uint64(0xC2B2AE3D27D4EB4F) + place)) + np.uint64(len(s))]))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def _survey(batches):
    """Per document its set's size and identity; per slice its frequent shingles and the costs by size."""
    for batch in batches:
        texts, ids = Texts(batch.column(1)), batch.column(0)
        for first, last in texts.slices(SLICE_BYTES):
            sets = shingles(*texts.words(first, last))
            names = [_identity(s) if len(s) else (0, 0) for s in sets]
            yield _survey_rows(_SET, ids[first:last], [x for x, _ in names], [x for _, x in names], [len(s) for s in sets])
            sets = [s for s in dict(zip(names, sets)).values() if len(s)]
            if not sets:
                continue
            shingle, df = counted(np.sort(np.concatenate(sets)))
            often = df >= FREQUENT_LOCALLY
            yield _survey_rows(_SHINGLE, shingle[often].view(np.int64), None, None, df[often])
            cost = np.zeros((len(SIZES) + 1, 2), np.int64)
            for s in sets:
                size = len(s)
                lists = np.sort(df[np.searchsorted(shingle, s)])[: _prefix(size, 1)]
                k = _prefix(size, 2)
                scanned = len(lists) + (lists - 1).sum() * size * SCAN_COST
                cost[np.searchsorted(SIZES, size, "right")] += (k * (k - 1) // 2, int(scanned))
            at = np.flatnonzero(cost.sum(axis=1))
            yield _survey_rows(_COST, at, cost[at, 0], cost[at, 1], np.zeros(len(at), np.int64))


def _survey_rows(kind, a, b, c, n):
    size = len(n)
    zeros = np.zeros(size, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(size, kind, np.int8)), a.cast(pa.int64()) if isinstance(a, pa.Array) else pa.array(a, pa.int64()),
        pa.array(zeros if b is None else b, pa.int64()), pa.array(zeros if c is None else c, pa.int64()),
        pa.array(n, pa.int64())], ["kind", "a", "b", "c", "n"])


def _boundary(costs: list) -> float:
    """The size at which the total of subsets below and lists above is least."""
    by = {r["a"]: (r["subsets"], r["lists"]) for r in costs}
    best, boundary = None, SIZES[0]
    for k, size in enumerate(SIZES):
        total = sum(s if at <= k else r for at, (s, r) in by.items())
        if best is None or total < best:
            best, boundary = total, size
    return boundary


def sketch_width(size: int) -> int:
    """Counters of a set's sketch: a power of two, for about eight shingles each."""
    return max(16, 1 << max(0, int(size - 1).bit_length() - 3))


POSTINGS = "shard int, sets binary, sizes binary, sketches binary, keys binary, owners binary"


def _postings(frequent: np.ndarray, rank: np.ndarray, boundary: float, shards: int):
    """Keys of the distinct sets of a slice, packed by the shard of the key, with the sketch of every set."""

    def ordered(s):
        if not len(frequent):
            return s
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        known = np.where(frequent[at] == s, rank[at], 0)
        return s[np.argsort(known, kind="stable")] if known.any() else s  # s is in order of its hashes

    def run(batches):
        posted = set()
        for batch in batches:
            texts = Texts(batch.column(0))
            for first, last in texts.slices(SLICE_BYTES):
                sets, sizes, sketches, keys = [], [], [], []
                for s in shingles(*texts.words(first, last)):
                    size = len(s)
                    if size < 4:  # sets this small link with equal sets only
                        continue
                    identity = _identity(s)
                    if identity in posted:
                        continue
                    posted.add(identity)
                    head, own = ordered(s)[: _prefix(size, 2)], []
                    if size < boundary:
                        i, j = np.array(list(combinations(range(len(head)), 2)), np.int64).reshape(-1, 2).T
                        own.append(mixed(mixed(np.minimum(head[i], head[j])) + np.maximum(head[i], head[j]) * np.uint64(3)))
                    if size >= 0.8 * boundary:
                        own.append(head[: _prefix(size, 1)])
                    width = sketch_width(size)
                    counters = np.bincount((s & np.uint64(width - 1)).astype(np.int64), minlength=width)
                    sets.append(identity[0])
                    sizes.append(size)
                    sketches.append(np.minimum(counters, 255).astype(np.uint8))
                    keys.append(np.concatenate(own))
                for low in range(0, len(sets), 1 << 16):
                    part = slice(low, low + (1 << 16))
                    yield from _packed(sets[part], sizes[part], sketches[part], keys[part], shards)

    return run


def _packed(sets, sizes, sketches, keys, shards):
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key = np.concatenate(keys)
    shard = (mixed(key) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for n in range(shards):
        mine = order[ends[n] : ends[n + 1]]
        if not len(mine):
            continue
        present, place = np.unique(owner[mine], return_inverse=True)
        yield pa.RecordBatch.from_arrays([
            pa.array([n], pa.int32()), pa.array([np.array([sets[x] for x in present], np.int64).tobytes()], pa.binary()),
            pa.array([np.array([sizes[x] for x in present], np.uint32).tobytes()], pa.binary()),
            pa.array([np.concatenate([sketches[x] for x in present]).tobytes()], pa.binary()),
            pa.array([key[mine].tobytes()], pa.binary()), pa.array([place.astype(np.uint16).tobytes()], pa.binary())],
            ["shard", "sets", "sizes", "sketches", "keys", "owners"])


class _Sketches:
    """Counters of many sets, by width."""

    def __init__(self, sizes: np.ndarray, flat: list[np.ndarray]):
        self.sizes = sizes.astype(np.int64)
        self.widths = np.array([sketch_width(n) for n in sizes.tolist()], np.int64)
        self.rows, self.tables = np.zeros(len(sizes), np.int64), {}
        for width in np.unique(self.widths).tolist():
            mine = np.flatnonzero(self.widths == width)
            self.rows[mine] = np.arange(len(mine))
            table = np.stack([flat[x] for x in mine]).astype(np.uint16)
            table[table == 255] = 1 << 14  # a full counter bounds nothing
            self.tables[width] = table

    def can_link(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether sizes and shared counters leave room for a similarity of 0.8."""
        a, b = self.sizes[x], self.sizes[y]
        out = 5 * np.minimum(a, b) >= 4 * np.maximum(a, b)
        wide, narrow = np.where(self.widths[x] >= self.widths[y], x, y), np.where(self.widths[x] >= self.widths[y], y, x)
        shape = self.widths[wide] * (1 << 32) + self.widths[narrow]
        for code in np.unique(shape[out]).tolist():
            w, v = code >> 32, code & (1 << 32) - 1
            at = np.flatnonzero(out & (shape == code))
            step = max(1, (1 << 22) // w)
            for first in range(0, len(at), step):
                part = at[first : first + step]
                left = self.tables[w][self.rows[wide[part]]].reshape(len(part), w // v, v).sum(axis=1, dtype=np.int32)
                shared = np.minimum(left, self.tables[v][self.rows[narrow[part]]]).sum(axis=1)
                out[part] = 9 * shared >= 4 * (a[part] + b[part])
        return out


SMALL_LIST = 24  # members up to which all lists of a length are tested at once


def _list_links(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one shard: a spanning forest of the pairs that share a key and can link."""
    sets, sizes, flat, keys, owners, at = [], [], [], [], [], 0
    for row in frame.itertuples(index=False):
        own, size = np.frombuffer(row.sets, np.int64), np.frombuffer(row.sizes, np.uint32)
        counters = np.frombuffer(row.sketches, np.uint8)
        cuts = np.cumsum([sketch_width(n) for n in size.tolist()])
        flat += np.split(counters, cuts[:-1])
        sets.append(own)
        sizes.append(size)
        keys.append(np.frombuffer(row.keys, np.uint64))
        owners.append(np.frombuffer(row.owners, np.uint16).astype(np.int64) + at)
        at += len(own)
    sets, first, again = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
    sketches = _Sketches(np.concatenate(sizes)[first], [flat[x] for x in first])
    keys, owners = np.concatenate(keys), again[np.concatenate(owners)]
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    parent = list(range(len(sets)))
    forest = []

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x, y):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            forest.append((x, y))

    pairs = []
    for n in range(2, SMALL_LIST + 1):
        lists = owners[starts[lengths == n][:, None] + np.arange(n)]
        i, j = np.triu_indices(n, 1)
        for low in range(0, len(lists), max(1, (1 << 20) // len(i))):
            x, y = lists[low : low + max(1, (1 << 20) // len(i))][:, [i, j]].transpose(1, 0, 2).reshape(2, -1)
            pairs.append(np.unique(np.minimum(x, y) * len(sets) + np.maximum(x, y)))
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    for low in range(0, len(pairs), 1 << 18):
        x, y = np.divmod(pairs[low : low + (1 << 18)], len(sets))
        sure = (x != y) & sketches.can_link(x, y)
        for a, b in zip(x[sure].tolist(), y[sure].tolist()):
            join(a, b)
    for k in np.flatnonzero(lengths > SMALL_LIST).tolist():
        members = np.unique(owners[starts[k] : starts[k] + lengths[k]])
        label = np.array([root(x) for x in members.tolist()])
        for i in range(len(members) - 1):  # only members of other components are tested, so a group of copies is met once
            rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
            if not len(rest):
                if (label == label[0]).all():
                    break
                continue
            hit = rest[sketches.can_link(np.full(len(rest), members[i]), members[rest])]
            for y in hit.tolist():
                join(int(members[i]), int(members[y]))
            if len(hit):
                label[np.isin(label, label[hit])] = label[i]
    edges = np.array(forest, np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": sets[edges[:, 0]], "v": sets[edges[:, 1]]}, dtype="int64")


def _overlap_forest(query: list[np.ndarray], listed: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
    """Spanning forest of the links between two lists of sets, by counting along inverted lists.

    ``same``: both are one list. Indices of ``listed`` begin at len(query) unless ``same``.
    """
    shift = 0 if same else len(query)
    tokens = np.concatenate(listed)
    owner = np.repeat(np.arange(len(listed)), [len(s) for s in listed])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    sizes = np.array([len(s) for s in listed], np.int64)
    parent = list(range(len(query) + (0 if same else len(listed))))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for q, s in enumerate(query):
        low, high = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
        n = high - low
        total = int(n.sum())
        if not total:
            continue
        ends = np.cumsum(n)
        places = np.arange(total) + np.repeat(low - (ends - n), n)
        overlap = np.bincount(owner[places], minlength=len(listed))
        for x in np.flatnonzero(9 * overlap >= 4 * (len(s) + sizes)).tolist():
            a, b = root(q), root(x + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                forest.append((q, x + shift))
    return forest


def _tile_links(frame: pd.DataFrame) -> pd.DataFrame:
    """Links of one tile pair; ``side`` 0 and 1 are its tiles, 2 is a tile met with itself."""
    texts = Texts(pa.array(frame["text"], pa.large_string()))
    sets = []
    for first, last in texts.slices(SLICE_BYTES):
        sets += shingles(*texts.words(first, last))
    sides, ids = frame["side"].to_numpy(), frame["doc_id"].to_numpy()
    if (sides == 2).all():
        forest, names = _overlap_forest(sets, sets, True), ids
    else:
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        if not len(left) or not len(right):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        forest = _overlap_forest([sets[i] for i in left], [sets[i] for i in right], False)
        names = np.concatenate([ids[left], ids[right]])
    pairs = np.array(forest, np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": names[pairs[:, 0]], "v": names[pairs[:, 1]]}, dtype="int64")


def _survey_stage(docs: DataFrame) -> DataFrame:
    return stage(docs.mapInArrow(_survey, "kind byte, a long, b long, c long, n long"), "shingle-survey")


def _candidates(docs: DataFrame, survey: DataFrame, frequent_shingles: int, boundary: float | None) -> DataFrame:
    """(set, group) of the distinct sets that share a key with another one."""
    spark = docs.sparkSession
    ranked = survey.filter(F.col("kind") == _SHINGLE).groupBy("a").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "a").limit(frequent_shingles).toPandas()  # bounded by the parameter; the order alone depends on it
    if boundary is None:
        boundary = _boundary(survey.filter(F.col("kind") == _COST).groupBy("a").agg(
            F.sum("b").alias("subsets"), F.sum("c").alias("lists")).collect())  # one row per size class
    hashes = ranked["a"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(hashes)
    rank = np.arange(len(hashes), 0, -1, dtype=np.int64)[by_hash]  # the most frequent comes last
    posted = survey.filter(F.col("kind") == _SET).agg(F.sum(F.col("n") / 5 + 1)).first()[0] or 0
    shards = max(1, int(-(-posted // SHARD_KEYS)))
    rows = docs.select("text").mapInArrow(_postings(hashes[by_hash], rank, boundary, shards), POSTINGS)
    edges = rows.groupBy("shard").applyInPandas(_list_links, "u long, v long")
    return components(edges).select(F.col("node").alias("set"), F.col("component").alias("group"))


def _tiles(members: DataFrame, tile_shingles: int) -> DataFrame:
    """(doc_id, unit, i, j, side): the tile pairs in which a document takes part.

    A group beyond ``tile_shingles`` is dealt over several tiles, and every pair of them is a unit; smaller
    groups share units.
    """
    totals = members.groupBy("group").agg(F.sum("n").alias("total"))
    n_small = totals.filter(F.col("total") <= tile_shingles).agg(F.sum("total").alias("t")).first()["t"] or 0
    shared = max(1, -(-n_small // tile_shingles))
    placed = members.join(totals, "group").withColumns({
        "parts": F.ceil(F.col("total") / tile_shingles),
        "unit": F.when(F.col("total") <= tile_shingles, F.pmod(F.xxhash64("group"), F.lit(shared))).otherwise(F.col("group")),
    }).withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    dealt = placed.select("doc_id", "unit", (F.col("parts") > 1).alias("own"), "tile", other)
    return dealt.select(
        "doc_id", "unit", "own", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        F.when(F.col("tile") == F.col("other"), 2).when(F.col("tile") < F.col("other"), 0).otherwise(1).alias("side"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 frequent_shingles: int = FREQUENT_SHINGLES, tile_shingles: int = TILE_SHINGLES,
                 boundary: float | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``; links at Jaccard 0.8 of five-word shingles.

    ``boundary`` parts light sets from heavy ones; by default it is where the measured costs are least.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    survey = _survey_stage(docs)
    sets = survey.filter(F.col("kind") == _SET).select(
        F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("b").alias("set"), F.col("c").alias("check"))
    named = sets.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = stage(named.groupBy("set", "check", "n_shingles").agg(F.min("doc_id").alias("first_id")), "equal-sets")

    groups = _candidates(docs, survey, frequent_shingles, boundary)
    members = stage(classes.join(groups, "set").select(
        "group", F.col("first_id").alias("doc_id"), F.col("n_shingles").alias("n")).distinct(), "jaccard-members")
    tiles = _tiles(members, tile_shingles)
    # one text per member: rows that repeat a doc_id may carry different texts. The plan is the same at every size
    wanted = docs.join(members.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").distinct()
    units = wanted.join(tiles, "doc_id")
    links = units.groupBy("unit", "own", "i", "j").applyInPandas(_tile_links, "u long, v long")
    # rows of one doc_id are one node, so their sets' classes are linked through it
    same_set = named.join(classes, ["set", "check", "n_shingles"]).select(
        F.col("doc_id").alias("u"), F.col("first_id").alias("v"))
    found = components(links.unionByName(same_set))
    return sets.join(found, sets["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
