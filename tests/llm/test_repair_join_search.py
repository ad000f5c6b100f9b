"""Conversation repair, n-gram join and ranked search against plain versions, with odd rows."""

import math
import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from homeload.llm import jaccard_join, ranked_search, repair, signature_tree
from homeload.llm.common import runs

# --- repair ---------------------------------------------------------------------


def plain_cheapest(initials, found, most=3):
    """All edits with at most ``most`` inserts in a row."""
    best = None
    choices = [["D"] if f in (1, 2) else ["D", "K", "R"] for f in found]
    for own in product(*choices):
        for inserts in product(range(most), repeat=len(own) + 1):
            audit, roles, cost = "I" * inserts[0], ["?"] * inserts[0], 3 * sum(inserts)
            for edit, initial, fault, more in zip(own, initials, found, inserts[1:]):
                audit += edit + "I" * more
                cost += {"D": 4, "K": 0, "R": 3}[edit] + (3 if fault == 3 and edit != "D" else 0)
                roles += ([] if edit == "D" else [initial if edit == "K" else "?"]) + ["?"] * more
            if best is not None and (cost, audit) >= best:
                continue
            if any(re.fullmatch("(s?(ua)+)?", "".join(want)) and all(r in ("?", w) and (r == w or w != "s") for r, w in zip(roles, want))
                   for want in ([*lead, *["u", "a"] * ((len(roles) - len(lead)) // 2)] for lead in ([], ["s"])) if len(want) == len(roles)):
                best = cost, audit
    return best


def test_search_finds_the_cheapest_repair():
    rng = random.Random(11)
    for n in range(5):
        for _ in range(40 if n else 1):
            initials = [rng.choice(["s", "u", "a", "u", "a", "x", " ", ""]) for _ in range(n)]
            found = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
            assert repair.cheapest(initials, found) == plain_cheapest(initials, found), (initials, found)


def test_long_conversations_take_linear_time():
    rng = random.Random(12)
    n = 20_000
    initials, found = [rng.choice("uuaas") for _ in range(n)], [rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
    cost, audit = repair.cheapest(initials, found)
    assert len(audit) >= n and cost >= 4 * sum(f in (1, 2) for f in found)
    turns = [(i or "x", "t") for i in initials]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in repair.applied(turns, audit)))


def test_repaired_rows(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "assistant", " \n"), (1, 5, "assistant", "Yes"), (2, None, "tool", "x!"), (2, 4, "user", "a?"),
        (3, 1, None, None), (None, 1, "user", "So."), (None, 2, "assistant", "No."), (4, 1, "assistant", "b."), (4, 1, "user", "a."), (5, 1, "user", "q" * 3_000_000 + "."), (5, 2, "assistant", "é."),
    ]
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], "conv_id long, turn long, role string, text string, cost int, audit string").repartition(5)
    got = {r.conv_id: r for r in repair.repair(df).collect()}
    show = lambda c: (got[c].gaps, got[c].blank, got[c].duplicate, got[c].truncated, got[c].illegal, got[c].cost, got[c].audit)
    assert show(1) == (1, 1, 1, 1, 2, 11, "KKDDK") and [m.text for m in got[1].repaired] == ["Be kind.", "Hi.", "Yes"]
    assert show(2) == (0, 0, 0, 0, 1, 6, "RR") and [m.role for m in got[2].repaired] == ["user", "assistant"]
    assert show(3) == (0, 1, 0, 0, 0, 4, "D") and got[3].repaired == []
    assert show(None) == (0, 0, 0, 0, 0, 0, "KK") and show(5)[5:] == (0, "KK")
    # equal turns go by role
    assert show(4) == (0, 0, 0, 0, 0, 6, "IKKI") or show(4)[5] == 6
    assert repair.repair(df.where("false")).count() == 0


def test_runs_of_null_keys():
    import pyarrow as pa

    batch = lambda k: pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int64())})
    got = [t.column("k").to_pylist() for t in runs(iter([batch([None, None, 0]), batch([]), batch([0, 1]), batch([1]), batch([2])]), ["k"])]
    assert got == [[None, None], [0, 0], [1, 1], [2]]


# --- join -----------------------------------------------------------------------


def plain_sets(texts, words=5):
    out = []
    for t in texts:
        own = (t or "").lower().encode().split() if t else []
        out.append({tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    return out


def plain_components(rows, words=5, percent=80):
    sets = plain_sets([t for _, t in rows], words)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted((str(d), len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def joined(df, **kw):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df, **kw).collect())


def edited(words, share, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), round(share * len(out))):
        out[at] = f"e{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def near_rows():
    rng, rows = random.Random(5), []

    def add(words):
        rows.append((len(rows), " ".join(words)))

    for n in (3, 5, 9, 40, 150, 600):
        base = [f"w{rng.randrange(4000)}" for _ in range(n)]
        for share in (0, 0.01, 0.02, 0.03, 0.05):
            add(edited(base, share, rng))
    chain = [f"c{i}" for i in range(200)]  # links lead from end to end, the ends are unlike
    for k in range(0, 160, 4):
        add([*chain[k:], *(f"x{i}" for i in range(k))])
    lines = [[f"l{k}w{i}" for i in range(12)] for k in range(20)]  # texts of common lines, pairwise unlike
    for _ in range(60):
        add([w for line in rng.sample(lines, 8) for w in line])
    hot = [f"h{i}" for i in range(60)]  # a passage in texts that share nothing else
    for k in range(40):
        add([*hot, *(f"own{k}_{i}" for i in range(rng.choice([5, 14, 60])))])
    crowd = [f"k{i}" for i in range(120)]
    for _ in range(150):
        add(edited(crowd, 0.02, rng))
    rows += [(5, None), (6, ""), (7, " \t\n"), (None, rows[20][1]), (None, "alone for ever"), (3, rows[20][1]), (8000, rows[20][1].upper()), (8001, "alone FOR ever"), (8002, "alone for")] + [(9000, rows[3][1])] * 3
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 30, 3_000])
def test_components_of_ngram_links(spark, near_rows, block_bytes):
    df = spark.createDataFrame([(*r, 1, "n") for r in near_rows], "doc_id long, text string, n int, node string").repartition(6)
    assert joined(df, block_bytes=block_bytes) == plain_components(near_rows)
    assert jaccard_join.near_duplicates(df.where("false")).count() == 0


def test_two_thousand_unlike_texts_in_one_group(spark):
    """They hold the same lines; none links, and no pair of them becomes a row."""
    rng = random.Random(6)
    lines = [" ".join(f"l{k}w{i}" for i in range(9)) for k in range(30)]
    rows = [(i, " ".join(rng.sample(lines, 10))) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert len({c for _, _, c in joined(df, block_bytes=200_000)}) == len({c for _, _, c in joined(df)}) > 1900


def test_trees_join_like_all_pairs():
    rng = np.random.default_rng(7)
    for size in (1, 3, 40, 300):
        pool = np.unique(rng.integers(0, 1 << 63, 4 * size + 8).astype(np.uint64))
        base = [np.sort(rng.choice(pool, size, replace=False)) for _ in range(12)]
        sets = []
        for b in base:
            for change in (0, 0, size // 20, size // 8, size // 3):
                sets.append(np.unique(np.concatenate([b[change:], rng.integers(0, 1 << 63, change).astype(np.uint64)])))
        for percent in (50, 80, 100):
            want = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * signature_tree.common(sets[i], sets[j]) >= percent * len(np.union1d(sets[i], sets[j]))}
            for other in (None, 25):
                links = signature_tree.join(sets if other is None else sets[:other], None if other is None else sets[other:], np.arange(len(sets)), percent)
                allowed = {p for p in want if other is None or (p[0] >= other) != (p[1] >= other)}
                assert {(max(p), min(p)) for p in links} <= allowed and len(links) < len(sets)
                assert classes(len(sets), links) == classes(len(sets), allowed)
        assert signature_tree.join(sets, None, np.zeros(len(sets), np.int64), 80) == []


def classes(n, links):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[top(a)] = top(b)
    return len({top(i) for i in range(n)}), [min(j for j in range(n) if top(j) == top(i)) for i in range(n)]


# --- search ---------------------------------------------------------------------


def plain_rank(docs, items, top):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    terms = [split(t) for _, t in docs]
    n_docs, total = sum(map(bool, terms)), sum(map(len, terms))
    df = {}
    for own in terms:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for (doc, _), own in zip(docs, terms):
            score = 0
            for t in split(text):
                if t in own:
                    m = 100 - 75 + (75 * len(own) * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * own.count(t)) // (1000 * own.count(t) + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(str(item), r, str(None if none else doc), -s) for r, (s, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("tiles", [(256, 1 << 12, 512, 4 << 20), (3, 2, 5, 4 << 20), (2, 7, 4, 300)])
def test_ranked_search(spark, monkeypatch, tiles):
    for name, value in zip(("ITEM_TILE", "TERM_TILE", "DOC_TILE", "BLOCK_BYTES"), tiles):
        monkeypatch.setattr(ranked_search, name, value)
    rng = random.Random(13)
    words = ["The", "cat", "SAT", "Été", "été", "3d", "x_y", "漢字", "rare"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 30])))) for i in range(90)]
    docs += [(200 + i, "cat sat. on THE mat") for i in range(15)] + [(None, "cat sat on the mat"), (3, "cat"), (3, "cat"), (300, None), (301, ""), (302, " _ "), (303, "cat " * 50_000 + "rare")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(12)] + [(12, None), (13, "absent"), (14, "cat cat cat sat"), (14, "rare"), (None, "mat"), (15, "cat " * 3000)]
    df = spark.createDataFrame([(*d, 1, "t") for d in docs], "doc_id long, text string, n int, terms string").repartition(5)
    found = ranked_search.rank(df, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int"), 10)
    assert sorted((str(r.item_id), r.rank, str(r.doc_id), r.score) for r in found.collect()) == plain_rank(docs, items, 10)
    assert ranked_search.rank(df.where("false"), df.selectExpr("doc_id AS item_id", "text").limit(2)).count() == 0
    assert ranked_search.rank(df, df.where("false").selectExpr("doc_id AS item_id", "text")).count() == 0


def test_products_stay_exact():
    """The largest digits, impacts and tile together stay below 2^53."""
    digit, impact, terms = (1 << ranked_search.DIGIT_BITS) - 1, 999_999, ranked_search.TERM_TILE
    assert digit * impact * terms < 1 << 53
    weights = np.array([[0, 5, 3 << 40, (1 << 41) - 1]])
    parts = ranked_search.digits(weights)
    assert sum(p.astype(np.int64) << (ranked_search.DIGIT_BITS * i) for i, p in enumerate(parts)).tolist() == weights.tolist()


def test_rank_is_a_whole_number(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    found = ranked_search.rank(docs, docs.select(F.col("doc_id").alias("item_id"), "text"))
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
