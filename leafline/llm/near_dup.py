"""Near duplicates: an exact Jaccard join on word shingles with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafline.llm.components import components
from leafline.llm.text import chunks, word_hashes
from leafline.session import broadcast_if_small, materialize

SHINGLE = 5
#: percent of the union that two linked sets share, at least
PERCENT = 75
#: children of a tree node
FANOUT = 8
#: bits of a signature for each shingle of its set, at least
DENSITY = 4
#: sets that one task holds at a time, and their shingles
SLICE_SETS, SLICE_SHINGLES = 512, 1 << 21
#: a shingle that so many texts of one batch share is ordered last; so many such
#: shingles are told apart, at most. This changes what is looked at, never what is found
FREQUENT, FREQUENT_MOST = 3, 500_000
#: rounds, at most, that only draw the slices of large groups together
ROUNDS = 2


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes. A text of
    fewer words has its whole sequence as the only one; without words, none."""
    hashed, offsets = word_hashes(texts)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.full(max(0, len(hashed) - size + 1), 0x51ED270B27B4F3CF, np.uint64)
        for k in range(size):
            rolled = (rolled ^ hashed[k : k + len(rolled)]) * np.uint64(0xD6E8FEB86659FD93)
            rolled ^= rolled >> np.uint64(32)
        for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if z - a >= size:
                out.append(np.unique(rolled[a : z - size + 1].view(np.int64)))
            elif z == a:
                out.append(np.zeros(0, np.int64))
            else:
                code = np.uint64(z - a)
                for h in hashed[a:z]:
                    code = (code ^ h) * np.uint64(0xA0761D6478BD642F)
                    code ^= code >> np.uint64(32)
                out.append(np.array([code], np.uint64).view(np.int64))
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A 64-bit fingerprint of a set, from its size and a sum and a xor over it."""
    with np.errstate(over="ignore"):
        h = shingles.view(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
        mixed = (h ^ (h >> np.uint64(28))).sum(dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
        mixed ^= np.bitwise_xor.reduce(h * np.uint64(0x8EBC6AF09C88C6E3)) if len(h) else np.uint64(0)
        mixed = (mixed ^ (mixed >> np.uint64(32)) ^ np.uint64(len(h))) * np.uint64(0x589965CC75374CC3)
    return int((mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Of two linked sets in one order, the first so many shingles of each have one in common."""
    return n - -(-n * percent // 100) + 1


# ---- signature trees --------------------------------------------------------


class Node:
    """Sets below it: the union of their bitmaps, the range of their sizes, how
    many shingles of one set share a bit, at most, and their label if they all
    have the same."""

    __slots__ = ("bits", "least", "most", "slack", "label", "below")

    def __init__(self, bits: int, least: int, most: int, slack: int, label, below):
        self.bits, self.least, self.most, self.slack, self.label, self.below = bits, least, most, slack, label, below


def width_of(n: int) -> int:
    """Bits of the signature of a set of n shingles, a power of two."""
    return max(64, 1 << (DENSITY * n - 1).bit_length())


def signature(shingles: np.ndarray) -> bytes:
    width = width_of(len(shingles))
    flags = np.zeros(width, np.uint8)
    flags[(shingles & (width - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def leaf(i: int, n: int, bits: int, label) -> Node:
    return Node(bits, n, n, n - bits.bit_count(), label, i)


def build_tree(leaves: list[Node]) -> Node:
    """Sets of like size and like first bit stand side by side; FANOUT nodes make one of the next level."""
    leaves = sorted(leaves, key=lambda x: (x.least, x.bits & -x.bits))
    while len(leaves) > 1:
        level = []
        for i in range(0, len(leaves), FANOUT):
            part, bits = leaves[i : i + FANOUT], 0
            for x in part:
                bits |= x.bits
            label = part[0].label if all(x.label == part[0].label for x in part) else None
            level.append(Node(bits, min(x.least for x in part), max(x.most for x in part), max(x.slack for x in part), label, part))
        leaves = level
    return leaves[0]


def may_link(a: Node, b: Node, percent: int = PERCENT) -> bool:
    """Whether sets below the nodes can be similar enough. Common shingles lie on
    common bits; on each bit beyond the first, a set has at most `slack` more."""
    if a.most * 100 < b.least * percent or b.most * 100 < a.least * percent:
        return False
    overlap = min(a.most, b.most, (a.bits & b.bits).bit_count() + min(a.slack, b.slack))
    return overlap * (100 + percent) >= percent * (a.least + b.least)


def pairs(a: Node, b: Node, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of sets of different labels that no bound rules out, one below each
    node; with a == b each pair once."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if (x.label is not None and x.label == y.label) or not may_link(x, y, percent):
            continue
        leaf_x, leaf_y = isinstance(x.below, int), isinstance(y.below, int)
        if leaf_x and leaf_y:
            yield x.below, y.below
        elif x is y:
            stack.extend((p, q) for i, p in enumerate(x.below) for q in x.below[i:])
        elif leaf_y or (not leaf_x and x.most - x.least >= y.most - y.least):
            stack.extend((p, y) for p in x.below)
        else:
            stack.extend((x, q) for q in y.below)


def candidates(sizes: list[int], bitmaps: list[bytes], labels: list, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """Pairs of sets of different labels that may be similar enough. Sets of one
    bitmap width share a tree; only equal and next widths can hold similar
    sets, and a bitmap folds onto half its width."""
    classes: dict[int, list[int]] = {}
    for i, b in enumerate(bitmaps):
        if sizes[i]:
            classes.setdefault(8 * len(b), []).append(i)
    for width, members in classes.items():
        whole = [leaf(i, sizes[i], int.from_bytes(bitmaps[i], "little"), labels[i]) for i in members]
        below = build_tree(whole)
        yield from pairs(below, below, percent)
        if 2 * width in classes:
            folded = [(i, int.from_bytes(bitmaps[i], "little")) for i in classes[2 * width]]
            yield from pairs(below, build_tree([leaf(i, sizes[i], b & ((1 << width) - 1) | b >> width, labels[i]) for i, b in folded]), percent)


def tree_links(sets: list[np.ndarray], labels: list, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between sets that join all similar ones: a spanning forest of the
    exact links, given that sets of one label are joined already."""
    parent = {x: x for x in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    found = []
    for i, j in candidates([len(s) for s in sets], [signature(s) for s in sets], labels, percent):
        a, b = root(labels[i]), root(labels[j])
        if a == b:
            continue
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            parent[a] = b
            found.append((i, j))
    return found


# ---- the join ---------------------------------------------------------------


def _profile(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, sig) of each text; and (token, n) of shingles that many texts of a batch share."""
    schema = pa.schema([("doc_id", kind), ("h", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("token", pa.int64())])
    held: list[np.ndarray] = []

    def frequent() -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
        at = n >= FREQUENT
        held.clear()
        none = pa.nulls(int(at.sum()))
        return pa.RecordBatch.from_arrays([none.cast(kind), none.cast(pa.int64()), pa.array(n[at], pa.int64()), none.cast(pa.int64()), pa.array(token[at])], schema=schema)

    for b in chunks(batches, "text"):
        sets = shingle_sets(b.column("text"))
        n, sig = [len(s) for s in sets], [set_hash(s) for s in sets]
        columns = [b.column("doc_id"), b.column("h"), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.nulls(len(n), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
        held += sets
        if sum(map(len, held)) > 2 << 20:
            yield frequent()
    yield frequent()


def _prefixes(batches: Iterator[pa.RecordBatch], late: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """(token, sig) for the first shingles of each set, those in `late` after all
    others; a set comes once per task."""
    seen: set[int] = set()
    for b in chunks(batches, "text"):
        tokens, sigs = [], []
        for s in shingle_sets(b.column("text")):
            sig = set_hash(s)
            if not len(s) or sig in seen:
                continue
            seen.add(sig)
            if len(late):
                at = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s
                s = np.concatenate([s[~at], s[at]])
            tokens.append(s[: prefix_length(len(s), percent)])
            sigs.append(np.full(len(tokens[-1]), sig))
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(sigs))], ["token", "sig"])


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
    """The sets of a task's texts by fingerprint, each once."""
    seen: set[int] = set()
    for b in chunks(batches, "text"):
        sets = {set_hash(s): s for s in shingle_sets(b.column("text"))}
        yield {sig: s for sig, s in sets.items() if sig not in seen}
        seen.update(sets)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sets in _fresh(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.list_(pa.int64()))], ["sig", "shingles"]
        )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for sets in _fresh(batches):
        bits = [signature(s) for s in sets.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(bits, pa.binary())], ["sig", "bits"])


def _partners(percent: int):
    def run(group: pa.Table) -> pa.Table:
        """The rows of a group that may link with a row of another label in it."""
        label, n = group.column("label").to_pylist(), group.column("n").to_pylist()
        some = [False] * len(label)
        for i, j in candidates(n, group.column("bits").to_pylist(), label, percent):
            some[i] = some[j] = True
        return group.select(["token", "x", "y", "sig", "label"]).filter(pa.array(some, pa.bool_()))

    return run


def _stars(percent: int):
    def run(group: pa.Table) -> pa.Table:
        """(a, b): each set of a group that may link with others of it, and the
        least set that such pairs lead to."""
        sig, least = group.column("sig").to_pylist(), {}

        def root(x: int) -> int:
            while least.setdefault(x, x) != x:
                least[x] = x = least[least[x]]
            return x

        for i, j in candidates(group.column("n").to_pylist(), group.column("bits").to_pylist(), group.column("label").to_pylist(), percent):
            a, b = root(sig[i]), root(sig[j])
            least[max(a, b)] = min(a, b)
        found = [(x, root(x)) for x in least if root(x) != x]
        return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return run


def _linker(percent: int):
    def run(group: pa.Table) -> pa.Table:
        """(label, root): the labels of a group that links join to a lesser one."""
        lists = group.column("shingles").combine_chunks()
        flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        order = {s: i for i, s in enumerate(group.column("sig").to_pylist())}  # a set may come twice
        rows, label = list(order.values()), group.column("label").to_pylist()
        labels = [label[i] for i in rows]
        least = {x: x for x in labels}

        def root(x: int) -> int:
            while least[x] != x:
                least[x] = x = least[least[x]]
            return x

        for i, j in tree_links([flat[ends[i] : ends[i + 1]] for i in rows], labels, percent):
            a, b = root(labels[i]), root(labels[j])
            least[max(a, b)] = min(a, b)
        joined = [(x, root(x)) for x in least if root(x) != x]
        return pa.table([pa.array([x for x, _ in joined], pa.int64()), pa.array([r for _, r in joined], pa.int64())], names=["label", "root"])

    return run


def _dealt(members: DataFrame, whole: bool) -> DataFrame:
    """`members` (token, sig, label, n) with the slices (x, y) in which they meet.
    A group of more than one slice is cut by hash; for `whole`, every two slices
    meet. Groups of one are left out."""
    weight = members.groupBy("token").agg(
        F.greatest(F.ceil(F.count("*") / SLICE_SETS), F.ceil(F.sum("n") / SLICE_SHINGLES)).cast("int").alias("slices"),
        F.count("*").alias("c"),
    )
    weight = materialize(weight.where("c > 1"), "near-weights")
    # groups that are cut are told to their rows, which are then dealt out by set: no task gets a whole one
    cut = weight.where("slices > 1").select("token", F.col("slices").alias("many"))
    spot = F.when(F.col("many").isNull(), F.col("token")).otherwise(F.xxhash64("sig"))
    one = weight.where("slices = 1").select(F.col("token").alias("spot"), "slices")
    dealt = members.join(broadcast_if_small(cut), "token", "left").withColumn("spot", spot).join(one, "spot", "left")
    dealt = dealt.withColumn("slices", F.coalesce("many", "slices")).where("slices is not null")
    dealt = dealt.withColumn("x", F.pmod(F.xxhash64("sig"), F.col("slices")).cast("int"))
    if not whole:
        return dealt.select("token", "sig", "label", "n", "x", F.lit(0).alias("y"))
    dealt = dealt.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return dealt.select("token", "sig", "label", "n", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """`members` with the component each set is in so far."""
    return members.join(broadcast_if_small(roots), "sig", "left").withColumn("label", F.coalesce("root", "sig")).drop("root")


def _open(members: DataFrame) -> DataFrame:
    """The groups of two components or more."""
    ends = members.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h"))
    return members.join(ends.where("l <> h").select("token"), "token", "left_semi")


def _joined(roots: DataFrame, fresh: DataFrame) -> DataFrame:
    """`roots` after components (label) were joined to others (root)."""
    found = components(fresh.select(F.col("label").alias("a"), F.col("root").alias("b"))).where("node <> root")
    found = materialize(found.select(F.col("node").alias("label"), F.col("root").alias("to")), "near-joined")
    moved = roots.join(found, roots["root"] == found["label"], "left").select("sig", F.coalesce("to", "root").alias("root"))
    # a label has no row of its own until it is joined to another
    return materialize(moved.unionByName(found.select(F.col("label").alias("sig"), F.col("to").alias("root"))), "near-roots")


def _rooted(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """(doc_id, h, n, root) for every row of `docs`: a hash of the text, how many
    shingles it has, and what all rows of its component have in common (null
    without words).

    1. Equal sets become one. 2. Two linked sets share one of their first
    shingles in any common order (prefix filter); frequent ones are ordered last.
    Sets that share one form a group. 3. Signature trees join each set's first
    group, in slices of bounded size, and slices by one set for each component.
    4. Where a group still holds two components, trees over bitmaps tell which
    pairs may link; what such pairs hold together is a family, and trees over
    its sets, every two slices of them, find all links that are left. Sets are
    read in full only where the bitmaps leave a link possible.
    Shuffled are prefixes once, bitmaps of sets in groups, and sets that may link."""
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    profile = slim.mapInArrow(lambda it: _profile(it, arrow_kind), f"doc_id {kind}, h long, n long, sig long, token long")
    profile = materialize(profile, "near-profile")
    rows = profile.where("token is null").select("doc_id", "h", "n", "sig")
    late = profile.where("token is not null").groupBy("token").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "token").limit(FREQUENT_MOST)
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(late.select("token").toArrow()["token"].to_numpy()))
    prefixes = slim.mapInArrow(lambda it: _prefixes(it, shared.value, percent), "token long, sig long")
    # a window spills a large group to disk; nothing is gathered into one row
    group = Window.partitionBy("token")
    spread = prefixes.withColumns({"low": F.min("sig").over(group), "high": F.max("sig").over(group)})
    groups = spread.where("low <> high").select("token", "sig").distinct()
    groups = materialize(groups, "near-groups")
    if groups.isEmpty():
        return materialize(rows.select("doc_id", "h", "n", F.when(F.col("n") > 0, F.col("sig")).alias("root")), "near-rows")
    classes = rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    wanted = materialize(groups.select("sig").distinct().join(classes, "sig"), "near-wanted")

    def texts_of(sigs: DataFrame) -> DataFrame:
        """A text for each of the fingerprints, and texts that share its id."""
        reps = wanted.join(sigs, "sig", "left_semi").select(F.col("rep").alias("__rep")).distinct()
        return slim.join(broadcast_if_small(reps), F.col("doc_id").eqNullSafe(F.col("__rep")), "left_semi")

    bitmaps = materialize(texts_of(wanted).mapInArrow(_bitmaps, "sig long, bits binary"), "near-bitmaps")
    groups = materialize(groups.join(broadcast_if_small(wanted.select("sig", "n")), "sig"), "near-members")

    def linked(partners: DataFrame) -> DataFrame:
        """(label, root) from the sets of `partners` (token, x, y, sig, label), read in full."""
        sets = texts_of(partners.select("sig")).mapInArrow(_sets, "sig long, shingles array<long>")
        rows = sets.join(broadcast_if_small(partners), "sig").groupBy("token", "x", "y")
        return materialize(rows.applyInArrow(_linker(percent), "label long, root long"), "near-links")

    def met(members: DataFrame):
        return members.join(bitmaps, "sig").groupBy("token", "x", "y")

    partner = "token long, x int, y int, sig long, label long"
    # one group for each set; of groups of one component nothing is left to find
    first = groups.groupBy("sig", "n").agg(F.min("token").alias("token")).withColumn("label", F.col("sig"))
    dealt = materialize(_dealt(materialize(first, "near-own"), False), "near-first")
    fresh = linked(materialize(met(dealt).applyInArrow(_partners(percent), partner), "near-partners"))
    # (sig, root) of sets that are not their component's first one: a set was in one group only
    roots = fresh.withColumnRenamed("label", "sig")
    # groups that were cut: one set for each component, as often as it takes to join most slices
    cut = materialize(dealt.where("x > 0").select("token").distinct().join(dealt, "token").select("sig").distinct(), "near-cut")
    for _ in range(ROUNDS):
        if cut.isEmpty():
            break
        one = _open(_labelled(groups.join(cut, "sig", "left_semi"), roots))
        one = one.groupBy("token", "label").agg(F.min(F.struct("sig", "n")).alias("m"))
        one = one.groupBy("m").agg(F.min(F.struct("token", "label")).alias("t")).select("t.token", "m.sig", "t.label", "m.n")
        partners = materialize(met(_dealt(materialize(one, "near-one"), False)).applyInArrow(_partners(percent), partner), "near-partners")
        fresh = linked(partners)
        if fresh.isEmpty():
            break
        roots = _joined(roots, fresh)
    # all that may still link, found by bitmaps, as families; each family is read once
    rest = _open(_labelled(groups, roots))
    by_size = Window.partitionBy("token").orderBy("n")
    near = lambda small, large: F.coalesce(100 * small >= percent * large, F.lit(False))
    n, before, after = F.col("n"), F.lag("n").over(by_size), F.lead("n").over(by_size)
    rest = rest.withColumn("near", near(before, n) | near(n, after)).where("near").drop("near")
    same = rest.groupBy("token").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("sig")).alias("who"), F.sum("n").alias("sum"))
    same = same.where("c > 1").groupBy("c", "who", "sum").agg(F.min("token").alias("token"))
    rest = materialize(rest.join(same.select("token"), "token", "left_semi"), "near-rest")
    edges = materialize(met(_dealt(rest, True)).applyInArrow(_stars(percent), "a long, b long"), "near-edges")
    if not edges.isEmpty():
        family = components(edges).select(F.col("node").alias("sig"), F.col("root").alias("token")).join(wanted.select("sig", "n"), "sig")
        dealt = _dealt(materialize(_labelled(family, roots), "near-family"), True)
        mixed = dealt.groupBy("token", "x", "y").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
        dealt = materialize(dealt.join(mixed.select("token", "x", "y"), ["token", "x", "y"], "left_semi"), "near-families")
        fresh = linked(dealt.select("token", "x", "y", "sig", "label"))
        if not fresh.isEmpty():
            roots = _joined(roots, fresh)
    rows = rows.join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    rows = rows.select("doc_id", "h", "n", F.when(F.col("n") > 0, F.col("root")).alias("root"))
    return materialize(rows, "near-rows")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`. Two texts link
    when their shingles in common are `percent` of those in either or more, and
    component_id is the least doc_id that links reach; copies link, and texts
    without words link with nothing. All links count, with no cap on a group.

    Null texts have no words. A null id counts as no id: it is never a
    component's id unless all of its rows are without one. Repeated ids come out
    once per row. Other columns are not looked at. Sets and shingles are told
    apart by 64-bit hashes."""
    rows = _rooted(docs, doc_id, text, percent)
    least = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    joined = rows.where("n > 0").join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return joined.unionByName(alone)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, unchanged, of which one of each component stays: the
    least id, nulls last, and of rows with that id the one with the least hash of
    its text, once. Rows without words all stay."""
    rows = _rooted(docs, doc_id, text, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = rows.where("n > 0").groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.h")
    counts = rows.groupBy("doc_id", "h").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    same = F.col("__id").eqNullSafe(F.col(doc_id)) & (F.col("__h") == F.xxhash64(F.col(text)))
    f, c = first.alias("f"), counts.alias("c")
    kept = c.join(f, F.col("c.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("c.h") == F.col("f.h")), "left")
    kept = kept.where("f.h is not null or c.n = 0").select(
        F.col("c.doc_id").alias("__id"), F.col("c.h").alias("__h"), ((F.col("c.c") > 1) & (F.col("c.n") > 0)).alias("__again")
    )
    kept = materialize(kept, "near-kept")
    once = docs.join(broadcast_if_small(kept.where("not __again")), same, "left_semi")
    again = kept.where("__again")
    if again.isEmpty():
        return once
    more = docs.join(broadcast_if_small(again), same, "left_semi").withColumn("__t", F.xxhash64(F.col(text)))
    return once.unionByName(more.dropDuplicates([doc_id, "__t"]).drop("__t"))
