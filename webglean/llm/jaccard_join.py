r"""N-gram Jaccard join by prefix trees: documents whose sets of word n-grams overlap enough.

A document's set holds its distinct ``N``-word shingles. Equal sets are one from the start. Shingles
are dealt out by hash and counted over all sets; a set whose shared shingles can't make up the
overlap links with nothing and is done, which is the fate of most. The other sets are ordered rarest
shingle first, the same order everywhere. Two linked sets share one of their first shingles, so sets
fall into blocks connected by these. In a block the sets are stored in a tree over their ordered
shingles; each set walks the tree once, sharing the overlap of common paths, and leaves a branch when
what remains on either side can't reach the overlap it needs. Pairs already connected need no look.
Blocks beyond ``BLOCK`` shingles are cut into parts and every pair of parts is joined in a task of its
own, so nothing is left out. Only spanning links leave a block; components come from these.

Links are exact but for equal hashes: 56 bits of the shingle hash count. Null ids link with nothing
and have no component. Empty and null texts have an empty set and are alone. Rows that share an id
are separate documents. Very long texts are used whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, forget
from .batches import short_batches, working
from .components import components

N = 5
# Shared at least 75 of 100 of the union.
SHARE = 75
# At least 2**LEAST_BITS counting tasks. Shingles that one of them and one block hold; bytes of text
# hashed at once.
LEAST_BITS = 6
COUNTED = 1_000_000
BLOCK = 2_000_000
CHUNK = 1 << 19
# Shingles that a task deals out at a time, and the sets among them that make a shingle hot.
UNIT = 500_000
HOT = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_PRIME = 0x9E3779B97F4A7C15
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after the other, and how many."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    word = ~_GAP[data]
    begins = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    ends = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    sums = np.concatenate([[_U(0)], np.cumsum((data + _U(1)) * _powers(len(data), _PRIME))])
    inverse = _powers(len(data), pow(_PRIME, -1, 1 << 64))
    words = _mix((sums[ends] - sums[begins]) * inverse[begins])
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begins, side="right")
    count = np.bincount(text, minlength=len(texts))
    first = np.cumsum(count) - count
    grams = np.zeros(max(0, len(words) - N + 1), np.uint64)
    for k in range(N):
        grams = grams * _U(0xD6E8FEB86659FD93) + words[k : k + len(grams)]
    grams, owner = _mix(grams + _U(N)), text[: len(grams)]
    inside = owner == text[N - 1 :]
    grams, owner = grams[inside], owner[inside]
    few = np.flatnonzero((count > 0) & (count < N))
    if len(few):  # the whole sequence as one
        whole = np.zeros(len(few), np.uint64)
        for k in range(N - 1):
            there = count[few] > k
            whole[there] = whole[there] * _U(0xD6E8FEB86659FD93) + words[first[few[there]] + k]
        grams = np.concatenate([grams, _mix(whole + count[few].astype(np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[fresh], np.bincount(owner[fresh], minlength=len(texts))


def _sets(texts: pd.Series) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts: from, to, hashes, and how many for each."""
    data, size, start = [], 0, 0
    for i, x in enumerate(texts):
        text = (x or "").encode()
        if data and size + len(text) > CHUNK:
            yield start, i, *_shingles(data)
            data, size, start = [], 0, i
        data.append(text)
        size += len(text)
    if data:
        yield start, len(texts), *_shingles(data)


def _names(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits that tell a set, two integers a set; unused for empty sets."""
    out = np.zeros((len(counts), 2), np.uint64)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        for k, salt in enumerate((0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
            out[full, k] = _mix(np.add.reduceat(_mix(hashes ^ _U(salt)), starts) + _U(salt))
    return out


def _named(df: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n, set`` of every row; ``set`` is null without shingles."""

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        working("jaccard_join")
        for batch in batches:
            for a, b, hashes, counts in _sets(batch["text"]):
                names = _names(hashes, counts)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b].array, "n": counts,
                    "set": [x.tobytes() if n else None for x, n in zip(names, counts)],
                })

    rows = short_batches(df).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInPandas(named, "doc_id long, n long, set binary")


def _units(batches: Iterator[pd.DataFrame], unit: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Shingles, the number of their set, and names and sizes of the sets; equal sets of a unit once."""
    def unit_of() -> tuple[np.ndarray, ...]:
        return np.concatenate(grams), np.concatenate(owners), np.stack(names), np.array(sizes, np.uint32)

    seen, grams, owners, names, sizes, total = set(), [], [], [], [], 0
    for batch in batches:
        for _, _, hashes, counts in _sets(batch["text"]):
            name, ends = _names(hashes, counts), np.cumsum(counts)
            for i, n in enumerate(counts.tolist()):
                if n and (own := name[i].tobytes()) not in seen:
                    seen.add(own)
                    grams.append(hashes[ends[i] - n : ends[i]].copy())
                    owners.append(np.full(n, len(names), np.uint32))
                    names.append(name[i])
                    sizes.append(n)
                    total += n
            if total >= unit:
                yield unit_of()
                seen, grams, owners, names, sizes, total = set(), [], [], [], [], 0
    if names:
        yield unit_of()


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


_DEALT = (
    "bucket long, turn long, names binary, sizes binary, counts binary, low binary, high binary,"
    "hot binary, weights binary"
)


def _dealt(df: DataFrame, text: str, bits: int) -> DataFrame:
    """Shingles by their first ``bits``: for each bucket the sets, and the rest of their hashes.

    A shingle that ``HOT`` sets of a unit have is counted there and sends its count alone; its sets
    travel in rows of their own, ``turn`` above 0, so no bucket has to hold them."""
    low = min(40, 56 - bits)

    def bucket_of(grams: np.ndarray) -> np.ndarray:
        return (grams >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        working("jaccard_join")
        for grams, owners, names, sizes in _units(batches, UNIT):
            order = np.argsort(grams, kind="stable")
            grams, owners = grams[order], owners[order]
            cuts = _runs(grams)
            count = np.diff(np.append(cuts, len(grams)))
            often = count >= HOT
            rows, turn = [], int(names[0][0] >> _U(2)) + 1  # tells the unit
            for a, n in zip(cuts[often], count[often]):
                own = owners[a : a + n]
                key = np.array([grams[a] & _U((1 << low) - 1)])
                rows.append((
                    int(bucket_of(grams[a : a + 1])[0]), turn, names[own].tobytes(),
                    sizes[own].tobytes(), b"", b"", b"", key.tobytes(), b"",
                ))
            hot, weight = grams[cuts[often]], count[often].astype(np.uint32)
            hot_bucket = bucket_of(hot)
            rare = np.repeat(~often, count)
            grams, owners = grams[rare], owners[rare]
            bucket = bucket_of(grams)
            order = np.lexsort((owners, bucket))
            grams, owners, bucket = grams[order], owners[order], bucket[order]
            rest = grams & _U((1 << low) - 1)
            for k in np.union1d(bucket, hot_bucket):
                a, b = np.searchsorted(bucket, [k, k + 1])
                own, own_count = np.unique(owners[a:b], return_counts=True)
                c, d = np.searchsorted(hot_bucket, [k, k + 1])
                rows.append((
                    int(k), 0, names[own].tobytes(), sizes[own].tobytes(),
                    own_count.astype(np.uint32).tobytes(), rest[a:b].astype(np.uint32).tobytes(),
                    (rest[a:b] >> _U(32)).astype(np.uint8).tobytes(),
                    (hot[c:d] & _U((1 << low) - 1)).tobytes(), weight[c:d].tobytes(),
                ))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in _DEALT.split(",")])

    return short_batches(df).select(F.col(text).cast("string").alias("text")).mapInPandas(dealt, _DEALT)


_SHARED = "kind int, set binary, n long, gram long, grams binary, sizes binary"


def _counted(dealt: DataFrame, bits: int) -> DataFrame:
    """Kind 0: ``set, n, grams``, the shingles of a bucket that other sets have, too. A shingle is
    given as a class of its count (8 bits) and its hash, so that numbers order it: rarest first.
    Kind 1: ``gram, grams``, a hot shingle's hash and that number. Kind 2: ``gram`` with the sets
    (``set``) of the unit ``n`` that have it."""
    low = min(40, 56 - bits)

    def counted(part: pd.DataFrame) -> pd.DataFrame:
        bucket = _U(int(part["bucket"].iloc[0]) << low)
        if part["turn"].iloc[0]:
            keys = [int(np.frombuffer(x, np.uint64)[0] | bucket) for x in part["hot"]]
            return pd.DataFrame({
                "kind": 2, "set": part["names"], "n": part["turn"], "gram": keys, "grams": b"", "sizes": part["sizes"],
            })

        def joined(column: str, kind: type | str) -> np.ndarray:
            return np.frombuffer(b"".join(part[column]), kind)

        names, place = np.unique(joined("names", "V16"), return_inverse=True)
        sizes = np.zeros(len(names), np.uint32)
        sizes[place] = joined("sizes", np.uint32)
        rest = joined("low", np.uint32) | joined("high", np.uint8).astype(np.uint64) << _U(32)
        owner = np.repeat(place.astype(np.uint32), joined("counts", np.uint32))
        order = np.lexsort((owner, rest))
        rest, owner = rest[order], owner[order]
        del order, place
        fresh = np.ones(len(rest), bool)
        fresh[1:] = (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])
        rest, owner = rest[fresh], owner[fresh]
        cuts = _runs(rest) if len(rest) else np.zeros(0, np.int64)
        once, count = rest[cuts], np.diff(np.append(cuts, len(rest)))
        # Counts of units add up; a set in two units counts twice, which only shifts the order.
        hot, at = np.unique(joined("hot", np.uint64), return_inverse=True)
        more = np.bincount(at, joined("weights", np.uint32), len(hot)).astype(np.int64)
        total = count.copy()
        known = np.searchsorted(once, hot)
        both = known < len(once)
        both[both] = once[known[both]] == hot[both]
        total[known[both]] += more[both]
        more[both] += count[known[both]]

        def ordered(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
            rank = np.minimum(255, np.floor(4 * np.log2(np.maximum(1, counts)))).astype(np.uint64)
            return rank << _U(56) | bucket | keys

        gram = np.repeat(ordered(once, total), count)
        kept = np.repeat(total > 1, count)
        gram, owner = gram[kept], owner[kept].astype(np.int64)
        order = np.argsort(owner, kind="stable")
        gram, owner = gram[order], owner[order]
        cuts = _runs(owner) if len(owner) else np.zeros(0, np.int64)
        rows = [
            (0, names[owner[a]].tobytes(), int(sizes[owner[a]]), 0, gram[a:b].tobytes(), b"")
            for a, b in zip(cuts, [*cuts[1:], len(gram)])
        ]
        rows += [
            (1, b"", 0, int(key | bucket), number.tobytes(), b"")
            for key, number in zip(hot, ordered(hot, more))
        ]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _SHARED.split(",")])

    return dealt.groupBy("bucket", "turn").applyInPandas(counted, _SHARED)


def _shared(counted: DataFrame) -> DataFrame:
    """``set, n, grams``: the shared shingles of the sets, in several rows."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def merged() -> pd.DataFrame:
            return pd.DataFrame({
                "set": list(found), "n": [sizes[x] for x in found],
                "grams": [b"".join(grams) for grams in found.values()],
            })

        found, sizes, total = {}, {}, 0
        for batch in batches:
            for row in batch.itertuples():
                names = np.frombuffer(row.set, "V16")
                for name, n in zip(names, np.frombuffer(row.sizes, np.uint32).tolist()):
                    name = name.tobytes()
                    found.setdefault(name, []).append(row.grams)
                    sizes[name] = n
                total += len(names)
            if total >= UNIT:
                yield merged()
                found, sizes, total = {}, {}, 0
        if found:
            yield merged()

    numbers = counted.filter("kind = 1").select("gram", "grams")
    hot = counted.filter("kind = 2").select("gram", "n", "set", "sizes").join(numbers, "gram")
    # A unit's rows together: each of its sets gets one row for all its hot shingles.
    hot = hot.repartition("n").select("set", "sizes", "grams").mapInPandas(spread, "set binary, n long, grams binary")
    return counted.filter("kind = 0").select("set", "n", "grams").union(hot)


def _needed(n: int, share: int) -> int:
    """Shingles that a set of ``n`` has in common with any set it links with, at least."""
    return -(-share * n // 100)


def _records(shared: DataFrame, share: int) -> DataFrame:
    """``set, n, grams, first``: sets that can link at all, their shared shingles in order, and the
    first ones, of which linked sets have one in common."""
    rows = shared.groupBy("set").agg(
        F.max("n").alias("n"),
        # A set's own shingles. Two units may both have sent a hot one: the row is the same.
        F.collect_set("grams").alias("parts"),
    ).filter(F.aggregate("parts", F.lit(0), lambda a, g: a + F.octet_length(g)) / 8 * 100 >= F.col("n") * share)

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams = [np.unique(np.frombuffer(b"".join(p), np.uint64)) for p in batch["parts"]]
            first = [
                g[: max(0, len(g) - _needed(n, share) + 1)].astype(np.int64) for g, n in zip(grams, batch["n"])
            ]
            yield pd.DataFrame({
                "set": batch["set"], "n": batch["n"], "grams": [g.tobytes() for g in grams],
                "first": first,
            })

    return rows.select("set", "n", "parts").mapInPandas(
        ordered, "set binary, n long, grams binary, first array<long>"
    )


class _Tree:
    """Sorted sequences as a tree with shared beginnings. A node is (from, to, begin, end): sequences
    ``from`` to ``to`` have the items ``begin`` to ``end`` in common below their parent."""

    def __init__(self, rows: list[np.ndarray], sizes: np.ndarray):
        self.rows = rows
        lengths = np.array([len(r) for r in rows])
        self.nodes, self.children = [], []
        stack = [(0, len(rows), 0, -1)]
        while stack:
            lo, hi, depth, parent = stack.pop()
            first, last = rows[lo], rows[hi - 1]
            same = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:same] != last[depth:same])
            end = depth + int(differ[0]) if len(differ) else same
            at = len(self.nodes)
            self.nodes.append((
                lo, hi, depth, end, int(sizes[lo:hi].min()), int(sizes[lo:hi].max()),
                int(lengths[lo:hi].max()) - end,
            ))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(at)
            if hi - lo == 1:
                continue
            # Sequences that end here come first; the rest part by their next item.
            i = lo
            while i < hi and lengths[i] == end:
                stack.append((i, i + 1, end, at))
                i += 1
            while i < hi:
                j = i + 1
                while j < hi and rows[j][end] == rows[i][end]:
                    j += 1
                stack.append((i, j, end, at))
                i = j


    def doors(self, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, in order, with the nodes and places where they stand among the ``firsts`` first ones
        of a sequence."""
        items, at, places = [np.zeros(0, np.uint64)], [np.zeros(0, int)], [np.zeros(0, int)]
        for k, (lo, hi, begin, end, *_) in enumerate(self.nodes):
            stop = min(end, int(firsts[lo:hi].max()))
            if stop > begin:
                items.append(self.rows[lo][begin:stop])
                at.append(np.full(stop - begin, k))
                places.append(np.arange(begin, stop))
        items, at, places = np.concatenate(items), np.concatenate(at), np.concatenate(places)
        order = np.argsort(items, kind="stable")
        return items[order], at[order], places[order]


def _common(few: np.ndarray, many: np.ndarray) -> int:
    """How many of the sorted items ``few`` are in ``many``, which is sorted and not empty."""
    where = np.searchsorted(many, few)
    where[where == len(many)] = len(many) - 1
    return int((many[where] == few).sum())


def _tree_links(
    rows: list[np.ndarray], sizes: np.ndarray, sides: np.ndarray | None, share: int
) -> list[tuple[int, int]]:
    """Spanning links of sorted sequences. ``sides``: only pairs of two sides are looked at."""
    tree, root, links = _Tree(rows, sizes), list(range(len(rows))), []
    # Linked sets have one of their first shingles in common: a set enters the tree there alone.
    firsts = [max(0, len(r) - _needed(int(n), share) + 1) for r, n in zip(rows, sizes)]
    doors, door_nodes, door_places = tree.doors(np.array(firsts))
    _, last, _, depth, smallest, _, deeper = np.array(tree.nodes).reshape(-1, 7)[door_nodes].T
    room = depth + deeper - door_places  # items from there on

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, own in enumerate(rows):
        n = int(sizes[i])
        first = own[: firsts[i]]
        starts, ends = np.searchsorted(doors, first), np.searchsorted(doors, first, side="right")
        count = ends - starts
        k = np.repeat(np.arange(len(first)), count)
        at = np.arange(len(k)) + np.repeat(starts - (np.cumsum(count) - count), count)
        least = np.maximum(smallest[at], _needed(n, share))
        enough = np.minimum(len(own) - k, room[at]) * (100 + share) >= share * (n + least)
        stack = []
        for k, d in zip(*(x[enough & (last[at] > i + 1)].tolist() for x in (k, at))):
            path = rows[tree.nodes[door_nodes[d]][0]][: door_places[d]]
            # Paths that hold an earlier shingle of the set were entered there.
            if not k or not len(path) or not _common(first[:k], path):
                stack.append((int(door_nodes[d]), 0, int(door_places[d])))
        while stack:
            at, shared, begin = stack.pop()
            lo, hi, _, end, least, most, below = tree.nodes[at]
            if hi <= i + 1:
                continue
            if hi - lo == 1 and (find(lo) == find(i) or sides is not None and sides[lo] == sides[i]):
                continue
            # The overlap needed is share of the union: (100 + share) * overlap >= share * sum.
            least = max(least, -(-share * n // 100))
            if most * 100 < share * n or least * share > 100 * n:
                continue
            need = -(-share * (n + least) // (100 + share))
            part = rows[lo][begin:end]
            left = len(own)
            if len(part):
                shared += _common(part, own)
                left -= int(np.searchsorted(own, part[-1], side="right"))
            if shared + min(left, below) < need:
                continue
            if hi - lo == 1:
                if (100 + share) * shared >= share * (n + int(sizes[lo])):
                    a, b = find(lo), find(i)
                    root[a] = b
                    links.append((i, lo))
                continue
            stack += [(child, shared, tree.nodes[child][2]) for child in tree.children[at]]
    return links


def _links(records: DataFrame, blocks: DataFrame, share: int, block: int) -> DataFrame:
    """``a, b``: links that span what is linked, within ``blocks(node, component)``."""
    sized = records.join(blocks.withColumnRenamed("node", "set"), "set")
    parts = sized.groupBy("component").agg(
        F.ceil(F.sum(F.octet_length("grams")) / 8 / block).alias("parts"), F.count(F.lit(1)).alias("sets")
    ).filter("sets > 1").drop("sets")
    sized = sized.join(parts, "component").withColumn("part", F.pmod(F.xxhash64("set"), F.col("parts")))
    # A part meets every part, itself too.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    sized = sized.withColumn("other", other).select(
        "component", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        "part", "set", "n", "grams",
    )

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(g, np.uint64) for g in group["grams"]]
        keys = [r.astype(">u8").tobytes() for r in rows]
        order = sorted(range(len(rows)), key=keys.__getitem__)
        names, part = group["set"].tolist(), group["part"].to_numpy()
        across = group["p"].iloc[0] != group["q"].iloc[0]
        found = _tree_links(
            [rows[i] for i in order], group["n"].to_numpy()[order], part[order] if across else None, share
        )
        return pd.DataFrame({
            "a": [names[order[i]] for i, _ in found], "b": [names[order[j]] for _, j in found],
        })

    return sized.groupBy("component", "p", "q").applyInPandas(joined, "a binary, b binary")


def join_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE,
    counted: int = COUNTED, block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``df``: the size of its set, and the
    smallest id that links lead to, its own included."""
    named = cut_lineage(_named(df, key, text))
    once = named.filter("set is not null").groupBy("set").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n")
    )
    total = once.agg(F.sum("n")).first()[0] or 0
    bits = min(24, max(LEAST_BITS, math.ceil(math.log2(max(1, total / counted)))))
    counts = cut_lineage(_counted(_dealt(df, text, bits), bits))
    records = cut_lineage(_records(_shared(counts), share))
    forget(counts)
    firsts = records.select("set", F.explode_outer("first").alias("gram"))
    heads = firsts.groupBy("gram").agg(F.min("set").alias("head"), F.count(F.lit(1)).alias("sets"))
    near = firsts.join(heads.filter("sets > 1"), "gram").filter(F.col("set") != F.col("head"))
    blocks = components(near.select(F.col("set").alias("a"), F.col("head").alias("b")).distinct())
    links = cut_lineage(_links(records, blocks, share, block))
    found = components(links)
    least = once.select("set", "least").join(found.withColumnRenamed("node", "set"), "set", "left")
    least = least.withColumn("component", F.coalesce("component", "set"))
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = least.join(ids, "component").select("set", "component_id")
    forget(records)
    alone = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.join(ids, "set", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), alone).alias("component_id"),
    )
