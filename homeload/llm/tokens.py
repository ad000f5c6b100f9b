"""Texts to token ids with a public tokenizer file, many texts at a time.

The tokenizer drops white space and never joins across it, so a text's ids are
the ids of its white-space-separated words in order. Words repeat far more
often than texts, so each distinct word is worked out once per worker. Words of
plain Latin letters, digits and signs are cut into the tokenizer's own pieces
here and only the merging of those is left to the library; every other word
goes through the library's whole chain. A word of plain ASCII letters is a
piece, lower-cased, and is remembered as that alone.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words and pieces a Python worker remembers before it starts over; they bound memory only.
KNOWN_WORDS, KNOWN_PIECES = 200_000, 400_000
SLICE_BYTES = 2 << 20
#: Fixed value: how the tokenizer file cuts lower-cased text, for the letters below.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+|\n"
PLAIN = r"^[!-~À-ÖØ-öø-ÿ]*$"
LETTERS = r"^[A-Za-z]+$"


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column``; every part has a row at least."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Table:
    """Id lists by key, kept as one array and start positions."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.place)
        self.place.update(zip(keys, range(first, first + len(keys))))
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def find(self, keys: list[str]) -> np.ndarray:
        """Places of ``keys``, -1 for unknown ones."""
        get = self.place.get
        return np.array([get(k, -1) for k in keys], np.int64)

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.starts[index + 1] - self.starts[index]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[index] - (ends - size), size)], size


class WordEncoder:
    """``encode(texts)`` gives all texts' ids one after another, and their number per text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core already
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.merges.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(33, 256) if re.match(PLAIN, chr(c))}
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words, self.pieces = Table(), Table()

    def learn_pieces(self, pieces: list[str]) -> np.ndarray:
        """Places of ``pieces`` in ``self.pieces``."""
        found = self.pieces.find(pieces)
        lacking = np.flatnonzero(found < 0).tolist()
        if not lacking:
            return found
        new = list(dict.fromkeys([pieces[i] for i in lacking]))
        lines = " ".join(new).translate(self.written).split(" ")
        texts = [" ".join(lines[i : i + 2000]) for i in range(0, len(lines), 2000)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.merges.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(new):
            raise ValueError("the tokenizer file does not close each piece with one word end")
        self.pieces.add(new, ids, np.diff(ends, prepend=0))
        found[lacking] = self.pieces.find([pieces[i] for i in lacking])
        return found

    def learn_words(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words in ``self.words``."""
        if len(self.words.place) > KNOWN_WORDS:
            self.words = Table()
        every = words.to_numpy(zero_copy_only=False).tolist()
        found = self.words.find(every)
        lacking = found < 0
        if lacking.any():
            words = words.filter(pa.array(lacking))
            plain = pc.and_(pc.match_substring_regex(words, PLAIN), self.unmarked(words))
            fast, slow = words.filter(plain).to_numpy(zero_copy_only=False).tolist(), words.filter(pc.invert(plain)).to_pylist()
            if fast:
                parts = re.findall(PIECES, "\n".join(fast).lower() + "\n")
                ends = [i for i, p in enumerate(parts) if p == "\n"]
                ids, size = self.pieces.gather(self.learn_pieces([p for p in parts if p != "\n"]))
                upto = np.concatenate([[0], np.cumsum(size)])
                self.words.add(fast, ids, np.diff(upto[np.array(ends) - np.arange(len(ends))], prepend=0))
            if slow:
                lists = [e.ids for e in self.whole.encode_batch_fast(slow, add_special_tokens=False)]
                lengths = np.fromiter(map(len, lists), np.int64, len(lists))
                self.words.add(slow, np.fromiter((i for x in lists for i in x), np.int64, lengths.sum()), lengths)
            found = self.words.find(every)
        return found

    def unmarked(self, words: pa.Array) -> pa.Array:
        """Whether words hold none of the tokenizer's added tokens."""
        out = pa.array(np.ones(len(words), bool))
        for s in self.special:
            out = pc.and_(out, pc.invert(pc.match_substring(words, s)))
        return out

    def learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, each word's first place in them and its number of ids."""
        if len(self.pieces.place) > KNOWN_PIECES:
            self.pieces = Table()
        letters = pc.and_(pc.match_substring_regex(words, LETTERS), self.unmarked(words))
        lowered = pc.ascii_lower(words.filter(letters)).to_numpy(zero_copy_only=False).tolist()
        place = self.learn_pieces(lowered)
        one, one_size = self.pieces.gather(place)
        place = self.learn_words(words.filter(pc.invert(letters)))  # may start a new table
        more, more_size = self.words.gather(place)
        is_piece = np.asarray(letters.to_numpy(zero_copy_only=False), bool)
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size[is_piece], size[~is_piece] = one_size, more_size
        begin[is_piece], begin[~is_piece] = np.cumsum(one_size) - one_size, len(one) + np.cumsum(more_size) - more_size
        return np.concatenate([one, more]), begin, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        filled = pc.not_equal(split.flatten(), "")
        words, full = split.flatten().filter(filled), np.asarray(filled.to_numpy(zero_copy_only=False), bool)
        coded = words.dictionary_encode()
        flat, begin, size = self.learn(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int64)
        size = size[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(upto[-1]) + np.repeat(begin[at] - upto[:-1], size)]
        cuts = np.asarray(split.offsets.to_numpy(), np.int64) - split.offsets[0].as_py()
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(full)])[cuts]])


def encoder(path: str) -> WordEncoder:
    """The worker process's own encoder; Spark reuses workers, so what one task learned serves the next."""
    kept = sys.modules.setdefault("_homeload_worker", types.ModuleType("_homeload_worker")).__dict__
    return kept.setdefault(path, None) or kept.update({path: WordEncoder(path)}) or kept[path]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to each text's ids."""
    return np.insert(ids, np.cumsum(lengths), end), lengths + 1
