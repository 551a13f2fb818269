from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F

from webglean.llm import decontam, queries

W = decontam.WINDOW


def words(text):
    text = text.replace("\x01", " ").replace("\x03", " ")
    text = regex.sub(r"(?<=[\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+)", "\x01\\1", text)
    units = "|".join(sorted(decontam.UNITS, key=len, reverse=True))
    text = regex.sub(rf"(?<=[0-9] ?)({units})(?![\p{{L}}\p{{N}}])", " \x03\\1", text)
    return [w for w in regex.split(r"[^\p{L}\p{N}\x01\x03]+", text.lower()) if w]


def slot(word):
    return word[0] in "\x01\x03" or word[0].isdigit()


def canonical(word):
    return word[0] if word[0] in "\x01\x03" else "0" if word[0].isdigit() else word


def brute(docs, items):
    """(document, item) pairs, the long way."""
    found, seen = set(), {}
    for item, text in sorted(items):
        known = words(text or "")
        if not known or seen.setdefault(tuple(map(canonical, known)), item) != item:
            continue
        telling = [
            i for i in range(len(known) - W + 1)
            if sum(not slot(w) for w in known[i : i + W]) >= decontam.LITERAL
        ]
        for doc, text in docs:
            own = words(text or "")
            if not telling:
                if own == known:
                    found.add((doc, item))
                continue
            covered = set()
            for shift in range(-len(known), len(own)):
                same, at, slots = set(), set(), defaultdict(set)
                for i in telling:
                    part = own[i + shift : i + shift + W] if i + shift >= 0 else []
                    if list(map(canonical, part)) == list(map(canonical, known[i : i + W])):
                        if part == known[i : i + W]:
                            same.add(i)
                            continue
                        at.add(i)
                        for old, new in zip(known[i : i + W], part):
                            if slot(old):
                                slots[old].add(new)
                covered |= same
                if all(len(v) == 1 for v in slots.values()):
                    covered |= at
            if len(covered) >= decontam.SHARE * len(telling):
                found.add((doc, item))
    return found


ITEM = "A farmer named Tom sells 12 apples and keeps 30 km of fence, so how many apples does Tom keep if 12 go?"
ITEMS = [
    (1, ITEM), (2, "short one"), (3, None), (4, ""), (5, "7 8 9 10 11 12 13"),
    (6, ITEM.replace("Tom", "Ann").replace("12", "15")), (7, "the cat sat on the mat near the door of the house"),
]
DOCS = [
    (1, "Before it. " + ITEM + " After it."),
    (2, ITEM.replace("Tom", "Eve").replace("12", "99").replace("km", "miles")),
    (3, ITEM.replace("12 go", "13 go")),  # one of two mentions changed
    (14, ITEM.replace("12 go", "13 go").replace("12 apples", "14 apples")),  # one slot, two new values
    (15, ITEM.replace("12 go", "13 go").replace("sells 12", "sells 14").replace("Tom keep", "Ann keep")),
    (4, ITEM[:60]), (5, "Short ONE!"), (6, "a short one here"), (7, "7, 8, 9, 10, 11, 12, 13"),
    (8, "1 2 3 4 5 6 7"), (9, None), (10, ""), (11, "the cat sat on the mat"),
    (12, "word " * 30_000 + "the cat sat on the mat near the door of the house"), (None, ITEM),
    (13, (ITEM + " ") * 50), (1, "another row of one id"),
]


def test_like_brute_force(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in DOCS], "doc_id long, text string, covered int").withColumn("_id", F.lit("mine"))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.id, r.item) for r in decontam.matches(docs, bench).collect()}
    assert got == brute([d for d in DOCS if len(d[1] or "") < 10_000], ITEMS) | {(12, 7)}
    assert {d for d, _ in got} == {1, 2, 3, 5, 7, 12, None, 13}
    flagged = decontam.flag(docs, bench)
    assert sorted(flagged.columns) == sorted(
        ["doc_id", "text", "_id", "covered", "contaminated", "n_items", "item_id", "changed"]
    )
    rows = flagged.collect()
    assert len(rows) == len(DOCS)
    assert {r.doc_id for r in rows if r.changed} == {2, 3}
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        d for d, _ in DOCS if d not in {1, 2, 3, 5, 7, 12, None, 13}
    )


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.flag(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.flag(docs.limit(0), bench).count() == 0


def test_large_benchmarks_join_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(map(str, decontam.matches(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 1)
    assert sorted(map(str, decontam.matches(docs, bench).collect())) == want


def test_query_finds_copies_and_nothing_else(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {d for d, t in docs if any(b in t for _, b in items)}
    rows = queries.op3_decontamination(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    got = {r.doc_id for r in rows if r.contaminated}
    assert want and want <= got
    joined = {k: " ".join(words(t)) for k, t in docs}
    for d in got - want:
        assert any(" ".join(words(b)[1:-1]) in joined[d] for _, b in items)
