"""Every stage and the whole pipeline against plain versions, with planted cases and odd rows."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from oracle import connect, data_dir
from test_llm import DOCUMENTS, ODD, plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from homeload.llm import simhash, stages, substrings
from homeload.llm.queries import ORACLES

SF = data_dir("0.001")


def plain_near(rows):
    """One row of each component: that of the smallest id, null ids last."""
    fps = [simhash.fingerprint((r["text"] or "").encode()) for r in rows]
    root = plain_components(dict(enumerate(fps)))
    best = {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if root[i] not in best or key < best[root[i]][0]:
            best[root[i]] = (key, r)
    return [r for _, r in best.values()]


def plain_substrings(rows):
    """Spans, cut as the operator cuts them, that some smaller id holds go."""
    small = lambda d: float("-inf") if d is None else d
    spans, least = [], {}
    for r in rows:
        digests, starts, ends, _ = substrings.chunks([(r["text"] or "").encode()])
        spans.append(list(zip(digests.tolist(), starts.tolist(), ends.tolist())))
        for d, _, _ in spans[-1]:
            least[d] = min(small(r["doc_id"]), least.get(d, small(r["doc_id"])))
    out = []
    for r, own in zip(rows, spans):
        raw = (r["text"] or "").encode()
        gone = np.zeros(len(raw), bool)
        for d, a, b in own:
            if least[d] < small(r["doc_id"]):
                gone[a:b] = True
        left = bytes(np.frombuffer(raw, np.uint8)[~gone]).decode()
        out.append(r | {"text": None if r["text"] is None else left, "removed": int(gone.sum())})
    return out


def plain_clean(rows, bench):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for text in bench:
        w = split(text)
        size = min(13, len(w))
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
    sizes, out = {len(w) for w in windows}, []
    for r in rows:
        w = split(r["text"])
        hit = set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def plain_pieces(rows):
    whole, out = Tokenizer.from_file(public_tokenizers.path(stages.TOKENIZER)), []
    for r in rows:
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), stages.SEQUENCE)):
            part = ids[at : at + stages.SEQUENCE]
            out.append((r["doc_id"], n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def packed(rows):
    """The pieces; sequences are gapless and not too long."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0, *(n for _, n in placed)])[:-1].tolist() and sum(n for _, n in placed) <= stages.SEQUENCE
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)


def shown(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def words(rng, n, low=0):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnrst')}{rng.randrange(low, low + 400)}" for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    """Near copies, passages of 51 words, spaceless repeats, benchmark windows, short and null texts."""
    rng, rows = random.Random(21), []
    passage, window = words(rng, 51, 1000), words(rng, 13, 2000)
    for i in range(12):
        rows.append((i, words(rng, 200)))
    rows += [(20 + i, rows[i][1]) for i in range(4)]  # exact copies
    rows += [(30 + i, rows[i][1].replace(" ", "  ", 3) + " " + words(rng, 1)) for i in range(4)]  # a word more
    rows += [(40 + i, f"{words(rng, 70)} {passage} {words(rng, 70)}") for i in range(3)]
    spaceless = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(300))
    rows += [(50 + i, f"{words(rng, 60)} {spaceless} {words(rng, 60)}") for i in range(2)]
    rows += [(60, f"{words(rng, 80)} {window.upper()} {words(rng, 80)}"), (61, f"{words(rng, 400)} {window} {words(rng, 400)}")]
    rows += [(70, "too short"), (71, None), (72, ""), (None, words(rng, 90)), (0, words(rng, 90)), (73, "x" + rows[0][1] * 30)]
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), (d, t, "en", "s", len(t or "")))) for d, t in rows], [window, None, "no such words"]


def test_stages_on_planted_cases(spark, planted, tmp_path):
    rows, bench = planted
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], DOCUMENTS).repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = stages.near_dedup(spark, docs, "").collect()
    assert shown([r.asDict() for r in near]) == shown(plain_near(rows)) and not {20, 21, 22, 23} & {r.doc_id for r in near}
    cut = stages.substring_dedup(spark, docs, "").collect()
    want = [r for r in plain_substrings(rows) if not r["removed"] or re.search(r"[^\x20\x09-\x0D]", r["text"])]
    assert shown([r.asDict() for r in cut]) == shown(want)
    by_id = {r["doc_id"]: r["removed"] for r in plain_substrings(rows)}
    assert by_id[41] > 150 and by_id[42] > 150 and by_id[51] > 700 and by_id[40] == by_id[50] == 0
    clean = stages.benchmark_decontamination(spark, docs, str(tmp_path)).collect()
    assert shown([r.asDict() for r in clean]) == shown(plain_clean(rows, bench)) and 60 not in {r.doc_id for r in clean} and 61 in {r.doc_id for r in clean}
    assert packed(stages.pack(spark, docs, "").collect()) == sorted(plain_pieces(rows), key=str)
    kept = {r.doc_id for r in stages.quality_rules(spark, docs, "").collect()}
    assert {1, 2, 60} <= kept and not {70, 71, 72} & kept


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    rows = [(*r, 1, "k", "t", True) for r in ODD]
    odd = spark.createDataFrame(rows, DOCUMENTS + ", n_removed int, key string, tell string, kept boolean")
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, SF)
    assert 0 <= out.count() and (name == "best-fit packing" or out.columns == odd.columns)
    assert stage(spark, odd.where("false"), SF).count() == 0


def test_whole_pipeline(spark):
    """``run`` equals the plain stages one after another; the quality verdict comes from its SQL."""
    con = connect(SF)
    names = ("doc_id", "text")
    rows = [dict(zip(names, r)) for r in con.execute("SELECT doc_id, text FROM documents").fetchall()]
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_quality_rules']}) WHERE kept").fetchall()}
    rows = plain_near([r for r in rows if r["doc_id"] in kept])
    rows = [r for r in plain_substrings(rows) if not r["removed"] or re.search(r"[^\x20\x09-\x0D]", r["text"])]
    rows = plain_clean(rows, [r[0] for r in con.execute("SELECT text FROM benchmark").fetchall()])
    assert packed(corpus_pipeline.run(spark, SF).collect()) == sorted(plain_pieces(rows), key=str)
