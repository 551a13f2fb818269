"""Shards of even row counts that keep equal texts together: balanced label propagation.

Documents with equal texts are linked through their text. Every document starts in a shard dealt by
its position; then rounds of joins move linked documents to the shard that holds most of their
neighbours. Documents of one text are alike, so a round works on counts: rows (text, shard, count),
at most ``shards`` rows a text, however many copies there are. A quota for every pair of shards,
worked out from the ``shards`` x ``shards`` matrix of wishes, keeps every shard within its size:
swaps cost nothing, other moves use the room that documents without links leave, as those go
wherever room is left in the end. Small groups move first. A group too large for any shard has to be
cut; it takes what room the others leave, shard after shard, fewest shards first. The law is ``rows``: shard sizes differ by one row at most.

Only DataFrame functions are used. Positions are prefix sums over (bucket, shard) counts, so no
window holds more than a bucket's rows. Null texts are linked with each other, not with empty ones;
null and repeated ids keep their rows. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import cut_lineage, forget

ROUNDS = 8
BUCKETS = 1024


def shard_rows(
    df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``df``."""
    docs = _documents(df, key, text, shards, buckets)
    total = docs.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    every = _groups(docs)
    # Fewer than ``shards`` + 1 texts can be that large.
    large = every.filter(F.col("total") > max(quota)).select("print", "total").distinct().collect()
    groups = every.filter(F.col("total") <= max(quota))
    for at in range(rounds):
        before = groups
        # After the first round only shards with room are aimed at.
        groups, moved = _propagate(before, quota, shards, closed=at > 0)
        if at > 1 and groups is not before:
            forget(before)
        if at and not moved:
            break
    if large:
        groups = groups.union(_fill(df.sparkSession, large, quota, _held(groups, shards)))
    placed = _place(docs, groups, quota, shards)
    return _slots(placed, shards)


def _documents(df: DataFrame, key: str, text: str, shards: int, buckets: int) -> DataFrame:
    """Narrow rows with their first shard and their position among equal texts of their bucket."""
    body = F.col(text).cast("string")
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit(""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(body)), F.lit(b"")).alias("print"),
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "print"), F.lit(buckets)).cast("int"))
    near = Window.partitionBy("bucket").orderBy("doc_id", "print")
    same = Window.partitionBy("bucket", "print").orderBy("doc_id")
    rows = cut_lineage(
        rows.withColumn("nth", F.row_number().over(near)).withColumn("same", F.row_number().over(same))
    )
    bases = _bases(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), ["bucket"])
    return rows.join(F.broadcast(bases), "bucket").withColumn(
        "first", F.pmod(F.col("base") + F.col("nth") - 1, F.lit(shards)).cast("int")
    ).drop("base", "nth")


def _bases(counts: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """Sum of ``n`` over the rows before, in ``order``, for each of ``keys``. ``counts`` has at most
    one row for each bucket (and shard)."""
    w = Window.partitionBy(*(keys or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")


def _fill(spark: SparkSession, large: list, quota: list[int], held: list[int]) -> DataFrame:
    """Counts of the large groups, taking the shards with most room first."""
    room = sorted(([q - h, s] for s, (q, h) in enumerate(zip(quota, held))), reverse=True)
    parts = []
    for text in sorted(large):
        left = text.total
        for place in room:
            n = min(left, place[0])
            if n > 0:
                parts.append((bytes(text.print), place[1], n, text.total))
                left, place[0] = left - n, place[0] - n
    made = [
        F.struct(
            F.lit(a).alias("print"), F.lit(s).alias("shard"), F.lit(n).cast("long").alias("n"),
            F.lit(t).cast("long").alias("total"),
        )
        for a, s, n, t in parts
    ]
    return spark.range(1).select(F.inline(F.array(*made)))


def _groups(docs: DataFrame) -> DataFrame:
    """``print, shard, n, total`` of texts that several documents have."""
    counts = docs.groupBy("print", F.col("first").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("print"))
    return cut_lineage(counts.withColumn("total", total).filter("total > 1"))


def _held(groups: DataFrame, shards: int) -> list[int]:
    held = [0] * shards
    for row in groups.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # a row a shard
        held[row.shard] = row.n
    return held


def _literal(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _propagate(
    groups: DataFrame, quota: list[int], shards: int, closed: bool
) -> tuple[DataFrame, int]:
    """One round: wishes, quotas, moves. Returns the new counts and how many documents moved."""
    held = _held(groups, shards)
    room = [q - h for q, h in zip(quota, held)]
    # Ties between shards go to another shard for every text, which keeps the wishes balanced.
    turn = F.pmod(F.xxhash64("print") + F.col("shard"), F.lit(shards))
    best = Window.partitionBy("print").orderBy(F.desc("open"), F.desc("n"), turn)
    marked = groups.withColumn("turn", turn).withColumn(
        "open", F.element_at(_literal(room), F.col("shard") + 1) > 0 if closed else F.lit(True)
    )
    wishes = marked.withColumns({
        "to": F.first("shard").over(best), "to_n": F.first("n").over(best),
        "to_turn": F.first("turn").over(best), "to_open": F.first("open").over(best),
    }).filter(
        "to_open and shard != to and (to_n > n or (to_n = n and to_turn < turn))"
    ).select("print", "shard", "to", "n", "total")
    # Ordered by group size, then text, in two levels: sums of small cells, then rows of a cell.
    wishes = wishes.withColumns({
        "class": F.log2("total").cast("int"), "cell": F.pmod(F.hash("print"), F.lit(256)),
    })
    cells = wishes.groupBy("shard", "to", "class", "cell").agg(F.sum("n").alias("n"))
    wanted = [[0] * shards for _ in range(shards)]
    for row in cells.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():  # shards squared
        wanted[row.shard][row.to] = row.n
    granted = _grants(wanted, room)
    if not any(map(any, granted)):
        return groups, 0
    bases = _bases(cells, ["class", "cell"], ["shard", "to"])
    inner = Window.partitionBy("shard", "to", "class", "cell").orderBy("print").rowsBetween(
        Window.unboundedPreceding, -1
    )
    grant = F.element_at(
        _literal([g for row in granted for g in row]), F.col("shard") * shards + F.col("to") + 1
    )
    # At most 256 cells for each of a few dozen classes and each pair of shards.
    moves = wishes.withColumn("before", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(
        F.broadcast(bases), ["shard", "to", "class", "cell"]
    ).withColumn(
        "n", F.greatest(F.lit(0), F.least(F.col("n"), grant - F.col("base") - F.col("before")))
    ).filter("n > 0")
    change = F.explode(F.array(
        F.struct(F.col("shard"), (-F.col("n")).alias("n")),
        F.struct(F.col("to").alias("shard"), F.col("n").alias("n")),
    ))
    changes = moves.select("print", "total", change.alias("c")).select("print", "c.shard", "c.n", "total")
    after = groups.union(changes).groupBy("print", "shard").agg(
        F.sum("n").alias("n"), F.max("total").alias("total")
    ).filter("n > 0")
    return cut_lineage(after), sum(map(sum, granted))


def _grants(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """How many documents may go from shard to shard: swaps, then what the room allows."""
    n = len(room)
    granted = [[min(wanted[a][b], wanted[b][a]) for b in range(n)] for a in range(n)]
    for b in range(n):
        left = max(0, room[b])
        for a in sorted(range(n), key=lambda a: granted[a][b] - wanted[a][b]):
            more = min(left, wanted[a][b] - granted[a][b])
            granted[a][b] += more
            left -= more
    return granted


def _place(docs: DataFrame, groups: DataFrame, quota: list[int], shards: int) -> DataFrame:
    """Deal the copies of each text to the shards that its counts name, and the rest to the room."""
    by_print = Window.partitionBy("print").orderBy("shard")
    ends = groups.groupBy("print").agg(
        F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts")  # a row a shard
    )
    cells = docs.groupBy("print", "bucket").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.join(ends, "print")
    earlier = by_print.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row a bucket
    cells = cells.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    at = F.col("base") + F.col("same") - 1
    start = F.struct(at.alias("left"), F.lit(None).cast("int").alias("shard"))
    found = F.aggregate(
        "parts", start,
        lambda done, part: F.struct(
            (done["left"] - part["n"]).alias("left"),
            F.when(done["shard"].isNull() & (done["left"] < part["n"]), part["shard"])
            .otherwise(done["shard"]).alias("shard"),
        ),
        lambda done: done["shard"],
    )
    # Joined by text and bucket: a text with many copies is spread over the buckets.
    rows = cut_lineage(
        docs.join(cells, ["print", "bucket"], "left")
        .withColumn("shard", F.when(F.col("parts").isNotNull(), found))
        .select("doc_id", "size", "text_crc32", "print", "bucket", "shard")
    )
    room = [q - h for q, h in zip(quota, _held(groups, shards))]
    free = rows.filter("shard is null")
    bases = _bases(free.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), ["bucket"])
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy("doc_id", "print"))
    sums = [sum(room[: s + 1]) for s in range(shards)]
    passed = F.filter(_literal(sums), lambda end: end <= F.col("base") + F.col("nth") - 1)
    free = free.join(F.broadcast(bases), "bucket").withColumn("nth", nth).withColumn(
        "shard", F.size(passed).cast("int")
    ).drop("base", "nth")
    return rows.filter("shard is not null").union(free.select(rows.columns))


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    bases = _bases(counts, ["bucket"], ["shard"])
    nth = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "print"))
    return rows.withColumn("nth", nth).join(F.broadcast(bases), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("base") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
