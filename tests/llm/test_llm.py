"""Operators of the optional subpackage against plain versions, exact round trips and SQL, with odd rows."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from oracle import compare, connect, data_dir
from tokenizers import Tokenizer

import corpus_pipeline
from homeload.llm import chat, decontaminate, exact_substrings, packing, quality, simhash, stages, substrings, token_files, tokens, url_filter, warc
from homeload.llm.components import components
from homeload.llm.queries import ORACLES, QUERIES
from homeload.llm.shared_keys import NO_ID
from homeload.session import shared_folder

SF = data_dir("0.001")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LINE = "one two three four five six seven eight nine ten eleven twelve thirteen "
PASSAGE = " ".join(f"word{i * i}" for i in range(70))
ODD = [
    (1, PASSAGE + " tail", "de", "s", 3), (2, "head of its own " + PASSAGE, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0),
    (5, " \n\t ", "en", "s", 3), (6, "ÀÉß ž 漢字 é <|endoftext|> don't\x1c\x85x", "en", "s", 3), (7, PASSAGE, "en", "s", 3), (7, PASSAGE, "en", "s", 3),
    (None, PASSAGE + " of nobody", "en", "s", 3), (8, LINE * 900, "en", "s", 3), (9, LINE * 900 + "x", "en", "s", 3), (10, "no#repeat " * 3 + "漢" * 5000, "zh", "s", 3),
    (11, "漢" * 5000, "zh", "s", 1),
]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    rows = [(*r, 1, "k", "t") for r in ODD]
    return spark.createDataFrame(rows, DOCUMENTS + ", n_removed int, key string, tell string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name])[0] is None


def documents(spark, sf_dir=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def plain_exact(rows):
    raw, least, out = [(NO_ID if d is None else d, (t or "").encode()) for d, t in rows], {}, []
    for d, t in raw:
        for i in range(len(t) - 49):
            least[t[i : i + 50]] = min(d, least.get(t[i : i + 50], d))
    for (doc, _), (d, t) in zip(rows, raw):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 49):
            if least[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((-1 if doc is None else doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def exact_rows(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def test_exact_substrings(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert exact_rows(exact_substrings.remove_repeats(docs)) == plain_exact(documents(spark))
    assert exact_rows(exact_substrings.remove_repeats(odd)) == plain_exact([r[:2] for r in ODD])
    assert exact_substrings.remove_repeats(none).count() == 0


def test_chunks_catch_long_passages_only(odd, none):
    got = {(r.doc_id, r.n_removed): r for r in substrings.remove_repeats(odd).withColumnRenamed("key", "k2").collect() for _ in [0]}
    rows = {}
    for (doc, _), r in got.items():
        rows.setdefault(doc, r)
    assert rows[2].text.startswith("head of its own ") and rows[2].n_removed > 400
    assert rows[None].n_removed == 0 and rows[3].text is None and rows[4].text == "" and rows[6].n_removed == 0
    assert rows[9].n_removed > 0 and rows[8].n_removed == 0 and rows[11].n_removed == 15000
    assert substrings.remove_repeats(none).count() == 0


def plain_components(fps):
    values = sorted(set(fps.values()))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                root[top(a)] = top(b)
    least = {}
    for d, v in fps.items():
        least[top(v)] = min(d, least.get(top(v), d))
    return {d: least[top(v)] for d, v in fps.items()}


def test_simhash_components(spark, odd, none):
    fps = {d: simhash.fingerprint((t or "").encode()) for d, t in documents(spark)}
    got = {r.doc_id: r.component_id for r in QUERIES["op5_simhash_dedup"](spark, SF).collect()}
    assert got == plain_components(fps)
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_bits():
    from xxhash import xxh64_intdigest

    hashes = [xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d", b"c d a")]
    want = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > 3)
    assert simhash.fingerprint(b"A b C  d a") == want and simhash.fingerprint(b"x y") == xxh64_intdigest(b"x y", 42)


@pytest.mark.parametrize("long_list", [2, 64])
def test_crowded_lists_link_like_short_ones(spark, long_list):
    rng = np.random.default_rng(1)
    values = {0x0123456789ABCDEF ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (300, 3))}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), long_list)
    roots = {r.node: r.root for r in components(links).collect()}
    plain = plain_components({v: v & (1 << 64) - 1 for v in signed})
    classes = {}
    for v in signed:
        classes.setdefault(plain[v], set()).add(roots.get(v, v))
    assert all(len(c) == 1 for c in classes.values()) and len({min(c) for c in classes.values()}) == len(classes)


def encoded(text, end):
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files(spark, odd, none):
    for rows, df in ((documents(spark), spark.read.parquet(f"{SF}/documents.parquet")), ([r[:2] for r in ODD], odd)):
        folder = shared_folder(spark, "tokens-test")
        token_files.write_tokens(df, folder, TOKENIZER, 2)
        got = sorted(token_files.read_digests(spark, folder).collect(), key=lambda r: r.start)
        whole = Tokenizer.from_file(TOKENIZER)
        ids = sorted((-1 if d is None else d, whole.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows)
        assert [(-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids]
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
        assert sorted(r.start for r in token_files.read_starts(spark, folder).collect()) == [r.start for r in got]
    folder = shared_folder(spark, "tokens-none")
    token_files.write_tokens(none, folder, TOKENIZER, 2)
    assert token_files.read_digests(spark, folder).count() == 0


def test_packing(spark, odd, none):
    cut = packing.pieces(odd, TOKENIZER, 0, 64, keep_ids=True)
    rows = packing.pack(packing.pieces(odd, TOKENIZER, 0, 64), 64, group_rows=16).collect()
    per_doc = {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in {r[0]: r[1] for r in ODD if r[0] != 7}.items():
        ids = encoded(text, 0)
        own = sorted(per_doc[doc], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), 64)) and sum(r.length for r in own) == len(ids)
        assert all(zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in own)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0, *(n for _, n in placed)])[:-1].tolist() and sum(n for _, n in placed) <= 64
    assert len(bins) <= -(-sum(r.length for r in rows) // 64) + 2
    assert packing.pack(packing.pieces(none, TOKENIZER, 0, 64), 64).count() == 0
    made = packing.sequences(packing.pack(packing.pieces(odd, TOKENIZER, 0, 64), 64), cut).collect()
    assert max(len(r.ids) for r in made) <= 64


def test_local_search_empties_bins():
    lengths = [6, 6, 6, 4, 4, 4, 3, 3, 2, 2]
    start = [[0, 3], [1, 4], [2, 5], [6, 7, 8], [9]]
    assert len(packing.local_search(start, lengths, 10)) == 4
    assert sorted(i for b in packing.local_search(packing.best_fit([5, 5, 4, 3, 3], 10), [5, 5, 4, 3, 3], 10) for i in b) == list(range(5))


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "http://b", None), (4, "u", ""), (None, "u", "ä" * 70000), (5, "u", "ä" * 70000), (2, None, "same")],
        "page_id long, url string, html string",
    )
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == [(0, 140000, "revisit", 5), (1, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 140000, "response", None)]
    assert warc.round_trip(pages.where("false")).count() == 0
    raw = warc.record_bytes(1, "u", b"body")
    assert warc.parse_record(raw)["payload"] == b"body"
    for bad in (raw[:-1], raw.replace(b"Content-Length: ", b"Content-Length: 1", 1), raw.replace(b"body", b"bodx"), raw.replace(b"WARC/1.1", b"WARC/9")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_chat_round_trip(spark):
    said = ["\\### Assistant: </turn> ok", "####\\1\\\\ </turn>\n</tur", "", None, ": \\0"]
    rows = [(c, t, role, text) for c, text in enumerate(said) for t, role in enumerate(["system", "user", "assistant", "to:ol", None])]
    df = spark.createDataFrame([*rows, (None, None, "user", "x")], "conv_id long, turn long, role string, text string")
    made = chat.format_chats(df)
    back = {r.conv_id: r for r in made.select("conv_id", "valid", "n_ok", chat.read_turns(made["formatted"]).alias("turns"), chat.read_loss(made["segments"]).alias("loss")).collect()}
    for c, text in enumerate(said):
        assert [(t.role, t.text) for t in back[c].turns] == [(r or "", text or "") for r in ["system", "user", "assistant", "to:ol", None]]
        assert back[c].loss == (text or "") and not back[c].valid and back[c].n_ok == 3
    assert chat.format_chats(df.where("false")).count() == 0


def test_any_template_can_be_read_back(spark):
    """Closing marks full of signs that mean something to a regular expression."""
    for close in ("<|im_end|>\n", "(.*)[a-z]+$ ^?{2}\n", ".|$x"):
        template = chat.Template(chat.TURNS.labels, chat.TURNS.after, ("assistant",), ("assistant",), open="<|im_start|>", mark="\n", close=close, controls=("<|", "|>", ".|$", "(.*)", "\n"))
        rows = [(1, 0, "user", f"a{close}b|im_end|\n<|"), (1, 1, "assistant", f"{close}{close}."), (1, 2, "to|ol", "")]
        made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), template)
        back = made.select(chat.read_turns(made["formatted"], template).alias("t"), chat.read_loss(made["segments"], template).alias("l")).first()
        assert [tuple(t) for t in back.t] == [r[2:] for r in rows] and back.l == rows[1][3]


def test_costs_follow_the_work(spark):
    """A rule is timed over so many passes that a dear one is told from a cheap one each time."""
    docs = spark.createDataFrame([("word " * 200 + "!",)] * 400, "text string").repartition(2)
    dear = F.length(F.regexp_replace(F.col("text"), "(w|o|r|d)+", "x")) > 0
    rules = {"dear": dear, "cheap": F.length("text") > 0, "never": F.length("text") < 0}
    assert [quality.cascade_order(docs, rules, share=1.0) for _ in range(3)] == [["cheap", "dear", "never"]] * 3
    assert quality.cascade_order(docs.where("false"), rules) == list(rules)


def test_quality_edges(odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows if r.text is None or r.q.n_words < 50)
    assert {r.q.n_repeat_words == r.q.n_words for r in rows if r.doc_id == 8} == {True}
    assert quality.judge(none).count() == 0


def test_mined_url_rules(spark):
    urls = [(f"http://spam.example/{i}", True) for i in range(20)] + [(f"http://good.example/{i}", False) for i in range(60)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    pages = spark.createDataFrame([(1, "https://x.spam.org/q"), (2, "http://good.example/"), (3, None), (4, "http://a.net"), (5, "http://b.net/#x")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, labelled, [("block", "net", "/")]).collect()}
    assert got == {1: ("x.spam.org", "/q", None, "block"), 2: ("good.example", "/", None, "allow"), 3: ("", "", None, "allow"), 4: ("a.net", "", None, "allow"), 5: ("b.net", "/", "net/", "block")}
    assert {r.verdict for r in url_filter.judge(pages, labelled.where("false"), []).collect()} == {"allow"}


@pytest.mark.parametrize("block_bytes", [1 << 20, 64])
def test_decontamination(spark, odd, none, block_bytes):
    bench = spark.createDataFrame([(1, LINE), (2, "word0 word1 word4"), (3, None), (2, "Word9 WORD16!"), (4, "absent words")], "item_id long, text string")
    got = decontaminate.find_matches(odd, bench, block_bytes=block_bytes).collect()
    assert len(got) == len(ODD)
    found = {(r.doc_id, r.n_words): sorted((m.item_id, m.word, m.words) for m in r.matches) for r in got}
    assert found[(1, 71)] == [(2, 0, 3), (2, 3, 2)] and found[(4, 0)] == []
    assert (1, 0, 13) in found[(8, 11700)]
    left = decontaminate.remove(odd, bench)
    assert left.columns == odd.columns and 8 not in {r.doc_id for r in left.collect()}
    assert decontaminate.find_matches(none, bench).count() == 0
    assert decontaminate.judge(odd, bench.where("false")).where("contaminated").count() == 0


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
    fps = {d: simhash.fingerprint((t or "").encode()) for d, t in documents(spark)}
    kept = {r.doc_id for r in stages.near_dedup(spark, docs, SF).collect()}
    assert kept == set(plain_components(fps).values())


def test_pipeline_runs_through(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


@pytest.mark.parametrize("known", [0, 5, 10**6])
def test_ids_stay_those_of_the_library_when_the_memory_starts_over(monkeypatch, known):
    """Words of letters alone are remembered once, as pieces, in whatever case; tables start over between batches."""
    monkeypatch.setattr(tokens, "KNOWN_WORDS", known)
    monkeypatch.setattr(tokens, "KNOWN_PIECES", known)
    coder, whole = tokens.WordEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    batches = [
        ["The the THE don't can't", None, "", "  \n", "Ünïcode straße 漢字 ab12cd !!?"], ["<|endoftext|> x<|startoftext|>y endoftext", "the don't é"],
        [None, ""], [f"Word{i} wordy{i % 3}! {'qz' * i}" for i in range(30)], ["The don't 漢字 can't 's 's's"],
    ]
    for texts in batches * 2:
        ids, lengths = coder.encode(pa.array(texts, pa.string()))
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    if known == 10**6:
        assert "don't" in coder.words.place and "the" in coder.pieces.place and not {"The", "the", "THE"} & set(coder.words.place)
