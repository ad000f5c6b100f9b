"""Repeated passages planted in texts of their own, against what substring deduplication removes."""

import random

from homeload.llm import substrings


def repeated(passage, rng, n=12):
    """Whether a second text that holds ``passage`` shares a span with the first."""
    own = lambda: " ".join(f"o{rng.randrange(10**9)}" for _ in range(n))
    a, b = (f"{own()} {passage} {own()}".encode() for _ in range(2))
    digests, starts, ends, counts = substrings.chunks([a, b])
    held = set(digests[: counts[0]].tolist())
    spans = [(s, e) for d, s, e in list(zip(digests.tolist(), starts, ends))[counts[0] :] if d in held]
    assert all(b[s:e] in a for s, e in spans)
    return bool(spans)


def test_every_passage_of_fifty_words_is_met():
    rng = random.Random(1)
    for n in (50, 51, 55, 60):
        for _ in range(300):
            assert repeated(" ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(n)), rng)


def test_passages_of_low_variety_are_met():
    rng = random.Random(2)
    for cycle in (1, 2, 3, 5, 8):
        for _ in range(60):
            words = [f"c{rng.randrange(10**6)}" for _ in range(cycle)]
            assert repeated(" ".join(words[i % cycle] for i in range(60)), rng)


def test_passages_without_white_space_are_met():
    rng = random.Random(3)
    for letters in ("".join(chr(0x4E00 + i) for i in range(3000)), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef0123456789+/", "{};=()ab"):
        for glued in (" ", "", "\u6f22"):
            for _ in range(60):
                passage = ""
                while len(passage.encode()) < 300:
                    passage += rng.choice(letters)
                sides = ["".join(rng.choices(letters, k=200)) for _ in range(4)] if glued != " " else [""] * 4
                a, b = (f"{sides[i]}{glued}{passage}{glued}{sides[i + 1]}".encode() for i in (0, 2))
                digests, _, _, counts = substrings.chunks([a, b])
                assert set(digests[: counts[0]].tolist()) & set(digests[counts[0] :].tolist())


def test_short_repeats_stay_and_slices_do_not_matter():
    rng = random.Random(4)
    assert not any(repeated(" ".join(f"s{rng.randrange(10**9)}" for _ in range(27)), rng) for _ in range(200))
    texts = [" ".join(f"t{rng.randrange(50)}" for _ in range(n)).encode() for n in (0, 1, 28, 90, 300)] + ["\u6f22".encode() * 400, b"", b"  x  " * 40, b"y" * 300]
    digests, starts, ends, counts = substrings.chunks(texts)
    at = 0
    for t, n in zip(texts, counts):
        alone = substrings.chunks([t])
        assert [x[at : at + n].tolist() for x in (digests, starts, ends)] == [x.tolist() for x in alone[:3]]
        assert all(t[s:e].decode() for s, e in zip(alone[1], alone[2]))
        at += n


def test_removal(spark):
    rng = random.Random(5)
    chinese = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    words = " ".join(f"p{rng.randrange(10**9)}" for _ in range(51))
    rows = [(1, "a b c " + chinese), (2, chinese + "d"), (3, "x y " + words + " z"), (4, words), (5, "q" * 20)]
    got = {r.doc_id: r for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[d].n_removed > 0 for d in range(1, 6)] == [False, True, False, True, False]
    assert got[2].n_removed > 1000 and len(got[4].text.split()) <= 23
