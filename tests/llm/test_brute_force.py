"""Operators that SQL cannot express, against brute-force versions on small tables and awkward rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siliscope.llm import decontamination, near_duplicates, private_data, repeats, sharding, token_counts
from siliscope.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = "Some words of a text that others were copied from, long enough to hold a hundred bytes and more of them in a row."
ROWS = [
    (1, None), (2, ""), (3, BASE), (4, "x " + BASE), (4, "another text under the same id " + BASE), (5, BASE + BASE), (6, "a" * 3000),
    (7, "ab" * 800), (8, "é文" * 200), (9, BASE.upper()), (10, "one"), (11, "one"), (12, "one two"), (None, BASE), (3, BASE),
]


@pytest.fixture(scope="module")
def tables(spark, data):
    given = spark.read.parquet(f"{data}/documents.parquet")
    odd = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    odd = odd.withColumn("row", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("node", F.lit(3)).withColumn("shard", F.lit(4))
    return {"given": given, "odd": odd, "empty": odd.limit(0)}


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def near(rows, size, percent):
    sets = []
    for _, text in rows:
        words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        runs = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(runs or ({tuple(words)} if words else set()))
    where, parent = collections.defaultdict(list), list(range(len(rows)))
    for i, one in enumerate(sets):
        for shingle in one:
            where[shingle].append(i)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j, n in collections.Counter(j for s in one for j in where[s] if j > i).items():
            if 100 * n >= percent * (len(one) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("name,size", [("given", 2), ("given", 5), ("odd", 2), ("empty", 2)])
def test_near_duplicates(tables, name, size):
    found = near_duplicates.near_duplicate_report(tables[name], size).collect()
    expected = near(rows_of(tables[name]), size, 80)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_large_group_of_near_copies(spark):
    """More classes than a table links pair by pair, some of which only some of the others are near to."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for doc in range(160):
        words = list(base)
        for _ in range(rng.choice([2, 4, 6, 9])):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates.near_duplicate_report(df, 2).collect()), key=repr)
    assert found == near(rows, 2, 80)


def test_members_of_a_large_group_stay_few_rows(spark, monkeypatch):
    """The rows looked up by table: a few per class, however many tables its members share."""
    rng, stored, rows = random.Random(3), near_duplicates.stored, []
    for doc in range(120):
        words = [f"w{i}" for i in range(120)]
        for _ in range(6):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    counts = {}

    def counted(table, name):
        out = stored(table, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(near_duplicates, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.near_duplicate_report(df, 2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == near(rows, 2, 80)
    assert 100 < counts["members"] <= near_duplicates.COLLECTION * counts["classes"]


def test_one_of_each_group_stays(tables):
    kept = near_duplicates.without_near_duplicates(tables["odd"], 2)
    assert kept.columns == tables["odd"].columns
    assert sorted(r.doc_id for r in kept.collect() if r.text == BASE) == [3]


def test_one_stays_though_ids_are_repeated_or_null(spark):
    words = [f"w{i}" for i in range(80)]
    texts = [" ".join([*words[:at], "other", *words[at:]]) for at in (0, 80, 40)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2])] + [(None, text.replace("w", "v")) for text in texts] + [(None, ""), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, "w5 " in r.text, "v5 " in r.text) for r in near_duplicates.without_near_duplicates(df, 2).collect()]
    assert sorted(kept, key=repr) == sorted([(1, True, False), (None, False, True), (None, False, False), (None, False, False)], key=repr)


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5000, 4000)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1050), 1000), 4000: 4000, 5000: 4000}


def removal(rows, length=100):
    first, out = {}, []
    last = (1 << 63) - 1
    order = sorted(((last if doc is None else doc, (text or "").encode()) for doc, text in rows), key=lambda x: x[0])
    for doc, data in order:
        for start in range(len(data) - length + 1):
            key = data[start : start + length]
            first[key] = min(first.get(key, (doc, start)), (doc, start))
    for doc, data in order:
        gone = np.zeros(len(data), bool)
        for start in range(len(data) - length + 1):
            if first[data[start : start + length]] < (doc, start):
                gone[start : start + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((None if doc == last else doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["given", "odd", "empty"])
def test_repeats(tables, name):
    found = repeats.repeat_report(tables[name]).collect()
    assert sorted((tuple(r) for r in found), key=repr) == removal(rows_of(tables[name]))


def test_names_fall_on_all_parts_alike():
    """A name is the least of many hashes; dealt by its size, a third of all entries would meet in one part."""
    text = np.random.default_rng(5).integers(32, 127, 200_000).astype(np.uint8)
    _, start, windows, name, whole = repeats.Fragments()(text, np.array([0, len(text)]))
    entries = np.zeros(len(name), repeats._ENTRY)
    entries["name"], entries["whole"], entries["start"], entries["windows"] = name, whole, start, windows
    hot = np.arange(len(name)) < 40
    found, part = repeats.by_part(entries, hot, 64)
    counts = np.bincount(part, minlength=64)
    assert counts.max() < 2 * counts.mean()
    heralds = found["windows"] == 0
    assert set(found["name"][heralds].tolist()) == set(name[hot].tolist())
    where = dict(zip(found["name"][heralds].tolist(), part[heralds].tolist()))
    cold, own = repeats.by_part(entries, ~np.ones(len(name), bool), 64)
    assert all(where.get(n, p) == p for n, p in zip(cold["name"].tolist(), own.tolist()))


def _variants(n: int) -> list[np.ndarray]:
    """Sets of 200 shingles that differ from each other in about 28, and each tenth from the one before in 8 at most."""
    random_, sets = np.random.default_rng(11), []
    base = random_.integers(-(1 << 62), 1 << 62, (6, 200))
    for i in range(n):
        pick = np.where(random_.random(200) < 0.08, random_.integers(1, 6, 200), 0)
        if i % 10 == 9:
            pick = last.copy()
            pick[random_.integers(0, 200, 4)] = 5
        last = pick
        sets.append(np.sort(base[pick, np.arange(200)]))
    return sets


def test_few_pairs_of_a_group_of_variants_are_confirmed(spark):
    """All members of one table, each its own component: every link is a candidate, but few of the other pairs are."""
    sets = _variants(240)
    links = set()
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (400 - common):
                links.add((a, b))
    members = spark.createDataFrame([(7, i, i, 200) for i in range(len(sets))], "table long, x long, component long, n long")
    packed = spark.createDataFrame([(i, found.tobytes()) for i, found in enumerate(sets)], "node long, found binary")
    found = {tuple(r) for r in near_duplicates._crossing(members, packed, 80).collect()}
    assert len(links) >= 24 and links <= found
    assert len(found) <= 3 * len(links) < 240 * 239 / 8


def test_repeats_of_a_hot_name(spark, monkeypatch):
    """A short passage in many surroundings: beyond the block's limit single windows are compared."""
    monkeypatch.setattr(repeats, "BLOCK_FRAGMENTS", 10)
    rng = random.Random(2)
    line = "a line of more than thirty-two bytes that is everywhere."
    rows = [(i, " ".join(f"{rng.randrange(10**6)}" for _ in range(9)) + line + "tail " * rng.randrange(20)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.repeat_report(df).collect()), key=repr) == removal(rows)


def test_run_length_index():
    rng = random.Random(3)
    base = bytes(rng.choice(b"ab") for _ in range(400))
    cuts = [(a := rng.randrange(200), a + rng.randint(100, 200)) for _ in range(15)]
    strings = [np.frombuffer(base[a:b], np.uint8) for a, b in cuts] + [np.frombuffer(b"a" * 168, np.uint8)] * 2
    found = set(zip(*(x.tolist() for x in repeats.later_windows(strings, np.arange(len(strings)), np.zeros(len(strings), np.int64)))))
    seen, expected = set(), set()
    for i, one in enumerate(strings):
        for offset in range(len(one) - 99):
            window = one[offset : offset + 100].tobytes()
            expected |= {(i, offset)} if window in seen else set()
            seen.add(window)
    assert found == expected


@pytest.mark.parametrize("name", ["given", "odd", "empty"])
def test_shards(tables, name):
    df = tables[name]
    found = sharding.shard_report(df).collect()
    expected = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows_of(df)]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=repr) == sorted(expected, key=repr)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[i]) for i in range(40)] if found else [0]
    assert max(counts) - min(counts) <= 1
    again = sharding.shard_report(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)
    assert sharding.shard_rows(df).columns == [*[c for c in df.columns if c != "shard"], "shard", "slot"]


def test_shards_match_the_mixture(tables):
    shards = sharding.shard_rows(tables["given"], shards=4).groupBy("shard").pivot("source").count().na.fill(0).toPandas()
    assert (shards.drop(columns="shard").max() - shards.drop(columns="shard").min() <= 2).all()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and private_data.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_personal_data(tables):
    rng = random.Random(4)
    automaton = private_data.anchor_automaton()
    texts = ["".join(rng.choice("ab1234567890@.+- ()\n%é:/-") for _ in range(rng.randrange(70))) for _ in range(20_000)]
    for text in [*texts, *(t or "" for _, t in rows_of(tables["given"]))]:
        assert [s for s in private_data.find_spans(text, automaton) if s[0] in private_data.BASE_KINDS] == base_spans(text)
    found = {r.doc_id: r for r in private_data.personal_data(tables["given"]).collect()}
    for doc, text in rows_of(tables["given"]):
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text or ""))
        assert found[doc].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert private_data.personal_data(tables["odd"]).count() == len(ROWS) and private_data.personal_data(tables["empty"]).count() == 0


def test_added_spans():
    automaton = private_data.anchor_automaton()
    text = "IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789, account no. 12345678, ftp://bob:pw@host/x and account of 12."
    added = [(k, text[a:b]) for k, a, b in private_data.find_spans(text, automaton) if k not in private_data.BASE_KINDS]
    assert added == [("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("account", "12345678"), ("login", "bob:pw@host")] or (
        "login", "ftp://bob:pw@host"
    ) in added


def test_decontamination(spark, tables):
    item = " ".join(f"tok{i}" for i in range(20))
    halves = item.split()
    rows = [
        (1, "before " + item.upper() + ", after"), (2, " ".join(halves[10:]) + " mid " + " ".join(halves[:10])), (3, "nothing of it"),
        (4, " ".join(halves[:8])), (None, item), (5, None), (6, ""), (7, "short one here and Yes."), (1, "before " + item.upper() + ", after"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_key", F.lit(1)).withColumn("seed", F.lit(1))
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (4, ""), (5, "Yes.")], "item_id long, text string").withColumn("seeds", F.lit(0))
    found = decontamination.contamination_report(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_tiles, r.coverage) for r in found), key=repr) == sorted(
        [(1, 1, 1, 1.0), (1, 1, 1, 1.0), (2, 1, 2, 1.0), (None, 1, 1, 1.0)], key=repr
    )
    assert sorted(r.doc_id for r in decontamination.decontaminated(docs, bench).collect()) == [3, 4, 5, 6, 7]
    short = decontamination.undecidable_items(bench).collect()
    assert sorted((r.item_id, r.item_tokens) for r in short) == [(2, 2), (3, 0), (4, 0), (5, 1)]
    assert decontamination.contamination_report(docs, bench.limit(0)).count() == 0
    assert decontamination.contamination_report(tables["empty"], bench).count() == 0


def test_short_items_need_full_coverage(spark):
    """Five to nine tokens: one shared phrase is not enough; every token counts, in one piece or, from ten on, in several."""
    five, eight = "one two three four five", "red green blue black white pink grey brown"
    rows = [(1, f"so {five} it is"), (2, "one two three four six"), (3, f"x {eight} y"), (4, "red green blue black white pink grey")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, five), (2, eight)], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.coverage) for r in decontamination.contamination_report(docs, bench).collect()}
    assert found == {(1, 1, 1.0), (3, 2, 1.0)}
    assert sorted(r.doc_id for r in decontamination.decontaminated(docs, bench).collect()) == [2, 4]


def test_report_equals_tiling_of_every_pair(spark, data):
    """The whole query against the plain definition: each document with each item, no candidates."""
    docs = spark.read.parquet(f"{data}/documents.parquet").filter("doc_id % 4 = 0")
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    items = [(r.item_id, TOKEN.findall((r.text or "").lower())) for r in bench.collect()]
    expected = set()
    for doc_id, text in rows_of(docs):
        tokens = TOKEN.findall((text or "").lower())
        runs = {tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)}
        for item_id, item in items:
            # Without a common run of five there is no tile.
            if not any(tuple(item[i : i + 5]) in runs for i in range(len(item) - 4)):
                continue
            covered = sum(n for _, _, n in plain_tiling(tokens, item, 5))
            if covered >= (1.0 if len(item) < 10 else 0.5) * len(item):
                expected.add((doc_id, item_id, covered))
    found = decontamination.contamination_report(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.covered_tokens) for r in found} == expected and expected


TOKEN = re.compile("[0-9a-z\x80-\U0010FFFF]+")


def plain_tiling(document, item, least):
    """Greedy tiling by the definition: the longest free match, the first of equals, until none has ``least`` tokens."""
    doc_free, item_free, laid = [True] * len(document), [True] * len(item), []
    while True:
        best = None
        for at in range(len(document)):
            for place in range(len(item)):
                n = 0
                while (
                    at + n < len(document) and place + n < len(item) and document[at + n] == item[place + n]
                    and doc_free[at + n] and item_free[place + n]
                ):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (at, place, n)
        if best is None:
            return laid
        at, place, n = best
        doc_free[at : at + n], item_free[place : place + n] = [False] * n, [False] * n
        laid.append(best)


def test_tiles_match_plain_tiling():
    rng = random.Random(5)
    for _ in range(300):
        letters = rng.choice([2, 3, 5])
        document, item = ([rng.randrange(letters) for _ in range(rng.randint(1, 40))] for _ in range(2))
        least = rng.choice([1, 2, 3, 5])
        found = decontamination.tiles(np.array(document, np.uint64), np.array(item, np.uint64), least, rng.choice([4, 20]))
        assert sorted(found) == sorted(plain_tiling(document, item, min(least, len(item)))), (document, item, least)


def test_tail_of_an_overlapping_match_is_a_tile(spark):
    item = [f"t{i}" for i in range(16)]
    text = " ".join(item[:7] + ["some", "filler"] + item[5:12])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    (row,) = decontamination.contamination_report(docs, bench).collect()
    assert (row.covered_tokens, row.n_tiles) == (12, 2)
    assert decontamination.decontaminated(docs, bench).count() == 0


def test_all_verbatim_passages_are_found(spark, data):
    docs, bench = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    items = bench.collect()
    expected = {(d, r.item_id) for d, t in rows_of(docs) for r in items if t and r.text in t}
    assert {(r.doc_id, r.item_id) for r in decontamination.contamination_report(docs, bench).collect()} >= expected


def test_token_histogram(tables):
    lengths = token_counts.token_lengths(tables["given"])
    counts = [r.n_tokens for r in lengths.collect()]
    histogram = token_counts.length_histogram(lengths, block=64)
    rows = histogram.collect()
    assert {r.n_tokens: r.n_docs for r in rows} == collections.Counter(counts)
    for r in rows:
        assert r.docs_at_least == sum(c >= r.n_tokens for c in counts) and r.total_tokens == sum(counts)
        assert r.truncated_tokens == sum(min(c, r.n_tokens) for c in counts)
    limits = {r.context: r for r in token_counts.at_limits(histogram, [0, 77, 10**6]).collect()}
    assert limits[77].truncated_tokens == sum(min(c, 77) for c in counts) and limits[77].docs_cut == sum(c > 77 for c in counts)
    middle = token_counts.quantiles(histogram, [0.5]).first().n_tokens
    assert middle == sorted(counts)[(len(counts) + 1) // 2 - 1]
    assert token_counts.length_histogram(token_counts.token_lengths(tables["odd"])).agg(F.sum("n_docs")).first()[0] == len(ROWS)
    assert token_counts.length_histogram(token_counts.token_lengths(tables["empty"])).count() == 0


def test_pipeline(spark, data):
    """Every stage against the brute-force versions of its decision."""
    import corpus_pipeline as pipeline
    from siliscope.llm import quality_rules

    docs = spark.read.parquet(f"{data}/documents.parquet")
    stages = dict(pipeline.STAGES)
    clean = stages["quality"](spark, docs, data)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in quality_rules.quality_report(docs).filter("kept").collect()}
    unique = stages["near_duplicates"](spark, clean, data)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(d for d, _, c in near(rows_of(clean), 5, 80) if d == c)
    free = stages["decontamination"](spark, unique, data)
    items = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    assert {d for d, t in rows_of(unique) if any(i in t for i in items)} == {d for d, _ in rows_of(unique)} - {d for d, _ in rows_of(free)}
    mixed = stages["mixing"](spark, free, data)
    shards = stages["sharding"](spark, mixed, data)
    assert all(df.columns == docs.columns for df in (clean, unique, free, mixed)) and shards.count() == mixed.count()
    assert pipeline.run(spark, data).count() == mixed.count()
