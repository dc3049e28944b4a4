"""Near-duplicate documents: MinHash signatures joined on their coordinates.

A document is its set of distinct shingles of WORDS words. Two documents are linked if the
Jaccard similarity of the sets is at least 80 %, confirmed on the full sets; the result is
the components of the links. The steps:

1. Documents with equal sets are one class, found by grouping on a fingerprint of the set.
2. Each class is posted under its signature's first POSTED coordinates, as coordinate-value
   pairs. Of these only the rarest are kept (prefix merging): two linked documents agree on
   MATCHED of POSTED coordinates, but for chance of about 1e-6, so among the POSTED - MATCHED
   + 1 rarest of each at least one is shared. Values of passages that many documents quote are
   thus skipped, and values of one class alone drop out.
3. Within a posting list, collisions are counted over all COORDINATES (a byte each); pairs
   below MATCH are skipped without looking at their texts. First, each class is confirmed
   against its best partner of the list only. Where the classes of a list then form one
   component, the list is done. In the others, every pair that crosses components and collides
   often enough is confirmed on the full sets, each pair in one list only. Pairs within a
   component are never written out.
4. Lists of more than LIST members are never compared member by member: see `field_links`,
   which posts them once more, by what sets them apart from a common hub.

Defined results: a null text, or one without words, has an empty set and is linked with
nothing; under WORDS words the whole sequence is the one shingle; rows with equal doc_id count
as one document that has the links of all of them; rows with a null doc_id are in no component
(component_id null) and are kept; an empty table gives no rows; other columns pass by.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import forgotten, lower_az, small, steps, table, tidied, written
from kinfold.llm.components import components

WORDS = 4
PERCENT = 80
COORDINATES = 128
POSTED = 32
MATCHED = 14
MATCH = 78
#: Members of a list that one task compares with one another, or a block of a longer list.
BLOCK = 256
#: Central members of a long list that all its blocks are compared with at first.
HUBS = 64
#: Members of a list that one task takes alone.
LIST = 2 * BLOCK

U = np.uint64
_rng = np.random.default_rng(20240229)
MULTIPLY = _rng.integers(1, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
ADD = _rng.integers(0, 2**32, COORDINATES, dtype=np.uint64).astype(np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


class WordKeys(dict):
    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(w)
        if len(self) < 100_000:
            self[w] = h
        return h


def shingle_set(words: list[bytes], keys: WordKeys, n: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a text's words."""
    if not words:
        return np.zeros(0, np.uint64)
    a = np.fromiter(map(keys.__getitem__, words), np.uint64, len(words))
    size = min(n, len(a))
    h = np.full(len(a) - size + 1, size, np.uint64)
    for k in range(size):
        h = mixed(h + a[k : len(a) - size + 1 + k])
    return np.unique(h)


def signature(s: np.ndarray) -> np.ndarray:
    """COORDINATES minima of 32-bit hashes, in bounded steps for very long texts."""
    x = (s >> U(32)).astype(np.uint32)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (x[i : i + 2048, None] * MULTIPLY + ADD).min(0), out=out)
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(s.tobytes(), digest_size=16).digest())


def signed(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, n, k1, k2, posted (array of long), sig (bytes) for every document."""

    def run(batches):
        keys = WordKeys()
        lanes = np.arange(POSTED, dtype=np.int64) << 32
        for b in batches:
            size, k1, k2, posted, sig = [], [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(lower_az(text or "").split(), keys, n)
                a, c = fingerprint(s)
                m = signature(s)
                size.append(len(s))
                k1.append(a)
                k2.append(c)
                posted.append(lanes | m[:POSTED].astype(np.int64))
                sig.append(m.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(posted, pa.list_(pa.int64())), pa.array(sig, pa.binary())], ["doc_id", "n", "k1", "k2", "posted", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: tidied(run(b)), "doc_id long, n long, k1 long, k2 long, posted array<long>, sig binary")


def full_sets(docs: DataFrame, wanted: DataFrame, n: int = WORDS) -> DataFrame:
    """doc, k1, set: the full sets of the wanted (doc, k1), computed again from the texts."""

    def run(batches):
        keys = WordKeys()
        for b in batches:
            sets = [shingle_set(lower_az(t or "").split(), keys, n) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([fingerprint(s)[0] for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc", "k1", "set"])

    ids = small(wanted.select(F.col("doc").alias("doc_id")).distinct())
    sets = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi").mapInArrow(lambda b: tidied(run(b)), "doc long, k1 long, set array<long>")
    return sets.join(wanted.select("doc", "k1").distinct(), ["doc", "k1"]).dropDuplicates(["doc", "k1"])


def postings(classes: DataFrame) -> DataFrame:
    """token, doc, k1, n, sig, tokens, shared: a row for each kept coordinate-value pair."""
    tokens = classes.select("doc", "k1", F.explode("posted").alias("token"))
    # written, so that the join reads it by an exchange of its own: Spark then splits hot values
    often = written(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "dedup-often")
    shared = tokens.join(often, "token").groupBy("doc", "k1").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("x"))
    # those of one class alone are the rarest of all, and take their places in the prefix
    keep = F.lit(POSTED - MATCHED + 1 - POSTED) + F.size("x")
    kept = shared.where(keep > 0).select("doc", "k1", F.transform(F.slice("x", 1, F.greatest(keep, F.lit(1))), lambda s: s["token"]).alias("tokens"), F.size("x").alias("shared"))
    full = kept.join(classes.select("doc", "k1", "n", "sig"), ["doc", "k1"])
    return full.select(F.explode("tokens").alias("token"), "doc", "k1", "n", "sig", "tokens", "shared")


def dealt(rows: DataFrame, left: Column, right: Column, lefts: Column, rights: Column) -> DataFrame:
    """rows once for each block pair (bi, bj) they belong to; role 1 left, 2 right, 3 both."""
    h = F.xxhash64("doc", "k1", "token")
    i, j = F.pmod(h, lefts).cast("int"), F.pmod(F.shiftright(h, 20), rights).cast("int")
    place = lambda a, b, role: F.struct(a.cast("int").alias("bi"), b.cast("int").alias("bj"), F.lit(role).alias("role"))
    none = F.array().cast("array<struct<bi:int,bj:int,role:int>>")
    as_left = F.when(left, F.transform(F.sequence(F.lit(0), (rights - 1).cast("int")), lambda y: place(i, y, 1))).otherwise(none)
    as_right = F.when(right, F.transform(F.sequence(F.lit(0), (lefts - 1).cast("int")), lambda x: place(x, j, 2))).otherwise(none)
    one = F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj"), (left.cast("int") + 2 * right.cast("int")).alias("role")))
    return rows.withColumn("at", F.explode(F.when((lefts == 1) & (rights == 1), one).otherwise(F.concat(as_left, as_right)))).select("*", "at.bi", "at.bj", "at.role").drop("at")


def groups(batches, columns: list[str], keys: tuple[str, ...]):
    """Runs of rows with equal keys of a sorted stream, as lists by column."""
    held: dict[str, list] | None = None
    last = None
    for b in batches:
        cols = {c: b.column(c).to_pylist() for c in columns}
        marks = list(zip(*(cols[k] for k in keys), strict=True))
        begin = 0
        for i in range(1, len(marks) + 1):
            if i < len(marks) and marks[i] == marks[begin]:
                continue
            if last is not None and marks[begin] != last:
                yield held
                held = None
            if held is None:
                held = {c: [] for c in columns}
            for c in columns:
                held[c] += cols[c][begin:i]
            last, begin = marks[begin], i
    if held is not None:
        yield held


def collisions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal coordinates of every left with every right signature, a few rows at a time."""
    out = np.empty((len(left), len(right)), np.int16)
    for i in range(0, len(left), 32):
        out[i : i + 32] = (left[i : i + 32, None, :] == right[None]).sum(2, dtype=np.int16)
    return out


def laid_out(g: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(-1, COORDINATES)
    role, n = np.array(g["role"]), np.array(g["n"])
    return sig, np.flatnonzero(role & 1), np.flatnonzero(role & 2), n


def comparable(n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Sizes that allow the similarity at all."""
    a, b = n_left[:, None], n_right[None]
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def best_partners(batches):
    """Of every left member of a block pair, the right one it collides with most."""
    for g in groups(batches, ["token", "bi", "bj", "role", "doc", "k1", "n", "sig"], BLOCKED):
        sig, le, ri, n = laid_out(g)
        if not len(le) or not len(ri):
            continue
        c = collisions(sig[le], sig[ri])
        doc, k1 = np.array(g["doc"]), np.array(g["k1"])
        same = (doc[le][:, None] == doc[ri][None]) & (k1[le][:, None] == k1[ri][None])
        c[~comparable(n[le], n[ri]) | same] = 0
        at = c.argmax(1)
        rows = []
        for x, y in enumerate(at):
            if c[x, y] >= MATCH:
                a, b = sorted(((g["doc"][le[x]], g["k1"][le[x]]), (g["doc"][ri[y]], g["k1"][ri[y]])))
                rows.append((*a, *b))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], ["a", "ka", "b", "kb"])


def needed_pairs(g: dict) -> list[tuple[int, np.ndarray]]:
    """Left members with the right ones they must be confirmed against in this list.

    These cross components, collide often enough, and have no common token before this one.
    """
    sig, le, ri, n = laid_out(g)
    if not len(le) or not len(ri):
        return []
    comp = np.array(g["comp"])
    ok = (collisions(sig[le], sig[ri]) >= MATCH) & comparable(n[le], n[ri]) & (comp[le][:, None] != comp[ri][None])
    token, out = g["token"][0], []
    width = max(map(len, g["tokens"]))
    earlier = np.full((len(n), width), -1, np.int64)
    for k, ts in enumerate(g["tokens"]):
        less = [t for t in ts if t < token]
        earlier[k, : len(less)] = less
    for x in np.flatnonzero(ok.any(1)):
        y = ri[ok[x]]
        own = earlier[le[x]]
        own = own[own >= 0]
        if len(own):
            y = y[~np.isin(earlier[y], own).any(1)]
        if len(y):
            out.append((int(le[x]), y))
    return out


CROSSING = ["token", "role", "doc", "k1", "n", "sig", "tokens", "comp"]


def members_needed(batches):
    """The members of each list whose full sets are needed there."""
    for g in groups(batches, CROSSING, ("token",)):
        used: set[int] = set()
        for x, ys in needed_pairs(g):
            used.add(x)
            used.update(ys.tolist())
        if used:
            k = sorted(used)
            take = lambda c, t: pa.array([g[c][i] for i in k], t)  # noqa: E731, B023
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([take(c, t) for c, t in zip(CROSSING, kinds, strict=True)], CROSSING)


def confirmed_links(batches):
    """Links across components, confirmed on full sets: one for a member and a component."""
    for g in groups(batches, [*CROSSING, "set"], ("token",)):
        rows = []
        sets = [np.array(s, np.int64) for s in g["set"]]
        for x, ys in needed_pairs(g):
            done = set()
            for y in ys.tolist():
                if g["comp"][y] in done:
                    continue
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= PERCENT * (len(sets[x]) + len(sets[y]) - common):
                    done.add(g["comp"][y])
                    rows.append((g["doc"][x], g["doc"][y]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], ["a", "b"])


BLOCKED = ("token", "bi", "bj")


def in_order(df: DataFrame, keys: tuple[str, ...] = BLOCKED) -> DataFrame:
    """Groups of rows dealt evenly, each one's rows together."""
    return df.repartition(*keys).sortWithinPartitions(*keys, "doc", "k1")


def first_links(posted: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """a, b: confirmed links of each class with its best partner in each list."""
    # only long lists need their size, and there are few: at most one for 2 * BLOCK postings
    sizes = small(written(posted.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > LIST), "dedup-sizes"))
    few = posted.join(sizes, "token")
    hubs = few.groupBy("token", F.pmod(F.xxhash64("doc", "k1"), F.lit(HUBS)).alias("h")).agg(F.max_by(F.struct("doc", "k1"), F.struct("shared", -F.col("doc"))).alias("hub")).select("token", F.col("hub.doc").alias("doc"), F.col("hub.k1").alias("k1"), F.lit(True).alias("hub"))
    marked = posted.join(sizes, "token", "left").join(small(written(hubs, "dedup-hubs")), ["token", "doc", "k1"], "left")
    long = F.col("m").isNotNull()
    lefts = F.when(long, F.ceil(F.col("m") / BLOCK)).otherwise(1)
    spread = dealt(marked, F.lit(True), ~long | F.coalesce("hub", F.lit(False)), lefts, F.lit(1))
    pairs = in_order(spread.select("token", "bi", "bj", "role", "doc", "k1", "n", "sig")).mapInArrow(best_partners, "a long, ka long, b long, kb long").distinct()
    pairs = written(pairs, "dedup-pairs")
    wanted = pairs.select(F.col("a").alias("doc"), F.col("ka").alias("k1")).union(pairs.select("b", "kb"))
    sets = written(full_sets(docs, wanted, n), "dedup-sets")
    of = lambda d, k, s: sets.select(F.col("doc").alias(d), F.col("k1").alias(k), F.col("set").alias(s))
    both = pairs.join(of("a", "ka", "sa"), ["a", "ka"]).join(of("b", "kb", "sb"), ["b", "kb"])
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= PERCENT * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def crossing_links(posted: DataFrame, docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """a, b: all links that cross the components found so far (at least one for each member
    and each component that it has a link to)."""
    named = posted.join(labels.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
    named = written(named, "dedup-named")
    parts = named.groupBy("token", "comp").agg(F.count("*").alias("c"))
    lists = parts.groupBy("token").agg(F.count("*").alias("comps"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top")).where("comps > 1")
    lists = written(lists.select("token", "m", F.col("top.comp").alias("field")), "dedup-lists")
    rows = named.join(lists, "token")
    short = rows.where(F.col("m") <= LIST).withColumn("role", F.when(F.col("comp") == F.col("field"), 2).otherwise(3))
    schema = "token long, role int, doc long, k1 long, n long, sig binary, tokens array<long>, comp long"
    needed = written(in_order(short.select(*CROSSING), ("token",)).mapInArrow(members_needed, schema), "dedup-needed")
    sets = full_sets(docs, needed, n)
    links = in_order(needed.join(sets, ["doc", "k1"]).select(*CROSSING, "set"), ("token",)).mapInArrow(confirmed_links, "a long, b long")
    long = lists.where(F.col("m") > LIST)
    if long.isEmpty():
        return links
    # written, so that the driver need not hold the plans of both kinds at once
    links = written(links, "dedup-crossing")
    forgotten(docs.sparkSession)
    return links.union(field_links(named.join(long, "token"), docs, n))


def field_links(rows: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """a, b: links across components in the lists that are too long for one task.

    Long lists of one largest component share most of their members: they are one field. Its
    hub is the member of that component with most coordinates in common with others. Every
    member is compared with the hub; d is the set of shingles that only one of the two holds.
    With R = (100 - PERCENT) / (100 + PERCENT), x and y are linked if

        |d(x)| + |d(y)| - 2 |d(x) & d(y)| <= R (|x| + |y|)

    so that one of them being far from the hub, they must share some of what sets them apart
    from it: at least `least` elements, as follows from | |x| - |hub| | <= |d(x)| and from the
    bound on the hub's own links. Members are posted under the rarest |d| - least + 1 elements
    of d, where elements held by one component alone come first and are not posted; what a
    field has in common is in no d. So pairs that cannot be linked hardly ever meet.
    """
    members = rows.groupBy("field", "doc", "k1").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.max("shared").alias("shared"))
    members = written(members, "dedup-members")
    heads = members.groupBy("field").agg(F.max_by(F.struct("doc", "k1"), F.when(F.col("comp") == F.col("field"), F.struct("shared", -F.col("doc")))).alias("hub"), F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    heads = small(written(heads.select("field", F.col("hub.doc").alias("hub"), F.col("hub.k1").alias("hub_k1"), "salts"), "dedup-heads"))
    sets = written(full_sets(docs, members, n), "dedup-field-sets")
    of_hub = sets.select(F.col("doc").alias("hub"), F.col("k1").alias("hub_k1"), F.col("set").alias("hub_set"))
    hubs = heads.join(of_hub, ["hub", "hub_k1"]).select("field", "hub", "hub_set", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dealt_out = members.join(heads.select("field", "salts"), "field").withColumn("salt", F.pmod(F.xxhash64("doc", "k1"), F.col("salts")).cast("int"))
    beside = dealt_out.join(sets, ["doc", "k1"]).join(hubs, ["field", "salt"])
    size, hub_size = F.col("n"), F.size("hub_set")
    common = F.size(F.array_intersect("set", "hub_set"))
    near = 100 * common >= PERCENT * (size + hub_size - common)
    other = ~F.col("near") & (F.col("comp") != F.col("field"))
    apart = F.concat(F.array_except("set", "hub_set"), F.array_except("hub_set", "set"))
    res = beside.select("field", "doc", "k1", "n", "comp", "hub", hub_size.alias("hub_n"), near.alias("near"), apart.alias("d")).withColumn("other", other)
    res = written(res, "dedup-residues")
    direct = res.where("near AND comp <> field").select(F.col("doc").alias("a"), F.col("hub").alias("b"))

    r = F.lit((100 - PERCENT) / (100 + PERCENT))
    d = F.size("d")
    bound = F.when(F.col("near"), (d + r * (F.col("hub_n") - F.col("n"))) / 2).otherwise((d - r * (F.col("n") + F.col("hub_n"))) / (1 + r))
    least = F.greatest(F.ceil(bound - 1e-6), F.lit(1))
    elements = res.select("field", "doc", "k1", "comp", "other", d.alias("size"), least.alias("least"), F.explode("d").alias("el"))
    crossing = elements.groupBy("field", "el").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("other").alias("other")).where("lo < hi AND other").select("field", "el", "df")
    crossing = written(crossing, "dedup-elements")
    listed = elements.drop("comp", "other").join(crossing, ["field", "el"]).groupBy("field", "doc", "k1").agg(F.first("least").alias("least"), F.sort_array(F.collect_list(F.struct("df", "el"))).alias("x"))
    keep = F.size("x") - F.col("least") + 1
    prefix = listed.where(keep > 0).select("field", "doc", "k1", F.explode(F.slice("x", 1, keep.cast("int"))).alias("p")).select("field", "doc", "k1", F.col("p.el").alias("el"))
    prefix = written(prefix.join(res.select("field", "doc", "k1", "n", "comp", "other", "d"), ["field", "doc", "k1"]), "dedup-prefixes")
    lists = prefix.groupBy("field", "el").agg(F.count("*").alias("m"), F.sum(F.col("other").cast("int")).alias("others"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("others > 0 AND lo < hi")
    met = prefix.join(written(lists.drop("lo", "hi"), "dedup-element-lists"), ["field", "el"])
    one = F.col("m") <= LIST
    spread = dealt(met.withColumn("token", F.col("el")), F.col("other"), F.lit(True), F.when(one, 1).otherwise(F.ceil(F.col("others") / BLOCK)), F.when(one, 1).otherwise(F.ceil(F.col("m") / BLOCK)))
    far = in_order(spread.select("field", "el", "bi", "bj", "role", "doc", "k1", "n", "comp", "d"), ("field", "el", "bi", "bj")).mapInArrow(apart_links, "a long, b long")
    return direct.union(far)


def apart_links(batches):
    """Links across components of members that share an element, by their sets d."""
    for g in groups(batches, ["field", "el", "bi", "bj", "role", "doc", "n", "comp", "d"], ("field", "el", "bi", "bj")):
        role, n, comp = np.array(g["role"]), np.array(g["n"]), np.array(g["comp"])
        le, ri = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        if not len(le) or not len(ri):
            continue
        lengths = np.fromiter(map(len, g["d"]), np.int64, len(n))
        starts = np.r_[0, np.cumsum(lengths)]
        flat = np.fromiter((e for d in g["d"] for e in d), np.int64, int(starts[-1]))
        codes = np.unique(flat, return_inverse=True)[1]
        held = np.zeros(int(codes.max()) + 1, bool)
        rows = []
        for x in le.tolist():
            own = codes[starts[x] : starts[x + 1]]
            held[own] = True
            both = np.add.reduceat(held[codes], starts[:-1])[ri]  # every d holds el: none is empty
            held[own] = False
            apart = lengths[x] + lengths[ri] - 2 * both
            ok = ((100 + PERCENT) * apart <= (100 - PERCENT) * (n[x] + n[ri])) & (comp[ri] != comp[x])
            _, first = np.unique(comp[ri[ok]], return_index=True)
            rows += [(g["doc"][x], g["doc"][y]) for y in ri[ok][first].tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], ["a", "b"])


def deduplicated(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    with steps(docs.sparkSession, "dedup-base", "dedup-classes", "dedup-components"):
        base = written(signed(docs, n), "dedup-base")
        real = base.where("n > 0 AND doc_id IS NOT NULL")
        classes = written(real.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("posted").alias("posted"), F.first("sig").alias("sig")), "dedup-classes")
        posted = written(postings(classes), "dedup-postings")
        first = written(first_links(posted, docs, n), "dedup-links")
        forgotten(docs.sparkSession)
        links = first.union(crossing_links(posted, docs, components(first), n))
        # rows that repeat a doc_id tie their classes together
        reps = classes.select("k1", "k2", "doc")
        ties = real.join(reps, ["k1", "k2"]).where(F.col("doc_id") != F.col("doc")).select("doc_id", "doc")
        twice = real.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
        repeated = ties.join(small(twice), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
        final = written(components(links.union(repeated)), "dedup-components")
    of_class = reps.join(final.withColumnRenamed("node", "doc"), "doc", "left").select("k1", "k2", F.coalesce("component", "doc").alias("component_id"))
    out = base.join(of_class, ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
