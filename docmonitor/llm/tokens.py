"""Tokenizing inside tasks: whole texts, exact ids, bounded memory.

The vocabularies used here cut a text into pre-tokens before merging, and no
pre-token reaches over the points where ``WordEncoder`` splits a text.  So the ids
of a text are the ids of its words in a row, and frequent words are encoded once a
worker instead of once an occurrence.  The cache has a bound, and words too long to
repeat are never kept.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

CACHE_WORDS = 500_000
CACHED_WORD_CHARS = 48
BATCH_CHARS = 1 << 18
ROW_WORDS = 64
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
MARKED = re.compile(r"[\s\x01]")
LINE = re.compile(r"(?<=\S)\n(?=\S)")
TAIL = re.compile(r"[^\W\d_]([.,;:!?*#$%&|<>]{1,4})\Z")
KNOWN_TAILS = 100_000


def batches(rows: Iterable[tuple], text_at: int = -1) -> Iterator[list[tuple]]:
    """Rows in lists of about ``BATCH_CHARS`` characters; a longer text is alone."""
    batch, chars = [], 0
    for row in rows:
        size = len(row[text_at] or "")
        if batch and chars + size > BATCH_CHARS:
            yield batch
            batch, chars = [], 0
        batch.append(row)
        chars += size + 64
    if batch:
        yield batch


class Generations:
    """A cache in two halves: when the new half is full it becomes the old one."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def find(self, words: set) -> tuple[dict, list]:
        """What either half has, as a small mapping of its own, and the words that neither has."""
        new, get_old, missing = self.new, self.old.get, []
        found = dict(zip(words, map(new.get, words)))
        for w in [w for w, value in found.items() if value is None]:
            value = get_old(w)
            if value is None:
                missing.append(w)
            else:
                new[w] = found[w] = value
        return found, missing

    def turn(self) -> None:
        if len(self.new) > CACHE_WORDS:
            self.old, self.new = self.new, {}


class LetterEnds(dict):
    """Which characters are letters that leave a stop or comma behind them a pre-token of its
    own.  The tokenizer says so itself, as it cuts what its normalizer made: some letters
    become a letter and a mark, and the mark takes the stop with it."""

    def __init__(self, tokenizer):
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer

    def __missing__(self, c: str) -> bool:
        self[c] = c.isalpha() and all(self._apart(c, tail) for tail in ".,")
        return self[c]

    def _apart(self, c: str, tail: str) -> bool:
        return self.cut(c + tail)[-1] == tail

    def cut(self, text: str) -> list[str]:
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        return [part for part, _ in self.pre_tokenizer.pre_tokenize_str(text)]


class Tails(dict):
    """Ids of the signs that end a word, by the letter before them and themselves, where they
    are a pre-token of their own behind it, else nothing.  The tokenizer is asked, as above."""

    def __init__(self, tokenizer, ends: LetterEnds, ids):
        self.ends, self.ids = ends, ids
        self.special = set().union(*(token.content for token in tokenizer.get_added_tokens_decoder().values()))

    def __missing__(self, key: str) -> bytes:
        if len(self) > KNOWN_TAILS:
            self.clear()
        letter, tail = key[0], key[1:]
        apart = self.special.isdisjoint(tail) and self.ends[letter] and self.ends.cut(key)[-1] == tail and self.ends.cut(tail) == [tail]
        self[key] = found = self.ids([tail])[tail] if apart else b""
        return found


class WordEncoder:
    """Encodes texts word by word with one of the public tokenizers.

    Where the vocabulary drops white space (a word ends in a mark of its own), a
    text may be cut at every space and line end.  Otherwise a space belongs to the
    word behind it, and a text is cut only before a space that stands between two
    characters which aren't white space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_space = not self.tokenizer.encode(" ", add_special_tokens=False).ids
        self.before = "" if self.drops_space else " "
        self.mark = " \x01 " if self.drops_space else "\n"
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.letter_ends = LetterEnds(self.tokenizer)
        self.tails = Tails(self.tokenizer, self.letter_ends, self._ids)
        # a line end between two words is a pre-token of its own, so words may be cut before it
        self.cuts_lines = not self.drops_space and self.letter_ends.cut("a\n1.\nb") == [
            "a", *self.letter_ends.cut("\n"), "1", ".", *self.letter_ends.cut("\n"), "b"]
        self.ids, self.spans = Generations(), Generations()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit integers."""
        split, found = self._words(texts, self.ids, self._ids_of)
        if self.drops_space:
            return [b"".join(map(found.__getitem__, words)) for words in split]
        first = self._ids(list({words[0] for words in split} - {""})) | {"": b""}  # no space stands before these
        return [first[words[0]] + b"".join(map(found.__getitem__, words[1:])) for words in split]

    def spans_many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of all tokens of each text, in characters."""
        split, found = self._words(texts, self.spans, self._spans_of)
        out = []
        for words in split:
            rows = [found[w] for w in words]
            if self.before:
                rows[0] = self._spans_of([words[0]], "")[words[0]]
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            at = np.cumsum(lengths) - lengths - len(self.before)
            at[0] = 0
            base = np.repeat(at, np.fromiter((r[0] for r in rows), np.int64, len(rows)))
            starts, ends = (np.frombuffer(b"".join([r[i] for r in rows]), "<i4") for i in (1, 2))
            out.append((base + starts, base + ends))
        return out

    def _words(self, texts: list[str], cache: Generations, encode) -> tuple[list[list[str]], dict]:
        """Each text's words, and a mapping that has all of them."""
        split = [(t.replace("\n", " ") if self.drops_space else t).split(" ") for t in texts]
        cache.turn()
        found, missing = cache.find(set().union(*split))
        odd = set() if self.drops_space else {
            w for w in missing if not w.isalpha() and (not w or w[0].isspace() or w[-1].isspace())}
        if odd:  # rare: these texts are cut more carefully
            split = [INNER_SPACE.split(t) if not odd.isdisjoint(words) else words
                     for t, words in zip(texts, split)]
            found, missing = cache.find(set().union(*split))
        if missing:
            got = encode(missing, self.before)
            found.update(got)
            cache.new.update([(w, v) for w, v in got.items() if len(w) <= CACHED_WORD_CHARS and (
                self.drops_space or w.isalpha() or w and not w[0].isspace() and not w[-1].isspace())])
        return split, found

    def _ids_of(self, words: list[str], before: str) -> dict[str, bytes]:
        """Ids of words, and of the parts of which some consist."""
        bare, cut, stems = [w for w in words if w.isalpha()], {}, {}
        for w in words:
            if not w.isalpha():
                stem, rest = self._parts(w)
                if rest or stem != w:
                    cut[w] = stem, rest
                    stems[stem] = None
                    continue
                bare.append(w)
        known, more = self.ids.find(set(stems).difference(bare))
        got = self._ids(bare + more, before)
        lines = self._ids(list({part for _, rest in cut.values() for part in rest if isinstance(part, str)}))
        end = self.mark_id.to_bytes(4, "little")
        for w, (stem, rest) in cut.items():
            ids = got[stem] if stem in got else known[stem]
            got[w] = ids + b"".join([end + lines[part] if isinstance(part, str) else part for part in rest])
        return got

    def _parts(self, word: str) -> tuple[str, list[str | bytes]]:
        """A word's stem and what follows it: ids of signs, and words that follow a line end."""
        stem, *lines = LINE.split(word) if self.cuts_lines and "\n" in word else (word,)
        rest: list[str | bytes] = []
        tail = TAIL.search(stem)
        if tail and (ids := self.tails[tail[0]]):
            stem, rest = stem[:tail.start(1)], [ids]
        return stem, rest + lines

    def _without_tails(self, words: list[str], cache: Generations) -> tuple[list[str], dict, dict[str, str]]:
        """What to encode, what is known, and words with their stems: a stop or comma behind
        a letter (see ``LetterEnds``) is a pre-token of its own, of one id."""
        ends = self.letter_ends
        tails = {w: w[:-1] for w in words if w[-1:] in (".", ",") and ends[w[-2:-1]]}
        stems, bare = cache.find(set(tails.values()).union(w for w in words if w not in tails))
        return bare, stems, tails

    def _ids(self, words: list[str], before: str = "") -> dict[str, bytes]:
        """Words without white space or the mark are encoded in rows, ``before`` in front of
        and a mark behind each: the mark is a pre-token of its own, whose id no
        such word yields."""
        plain = [w for w in words if w.isalpha() or w and (before or w[1:]) and not MARKED.search(w)]
        rows = [plain[i:i + ROW_WORDS] for i in range(0, len(plain), ROW_WORDS)]
        encoded = self.tokenizer.encode_batch_fast(
            [before + (self.mark + before).join(row) + self.mark for row in rows], add_special_tokens=False) if rows else []
        found = {}
        for row, e in zip(rows, encoded):
            ids = np.array(e.ids, "<u4")
            cuts = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            if len(cuts) == len(row):
                raw = ids.tobytes()
                found.update(zip(row, [raw[a:b] for a, b in zip([0, *[c + 4 for c in cuts]], cuts)]))
        rest = [w for w in words if w not in found] if len(found) < len(words) else []
        encoded = self.tokenizer.encode_batch_fast([before + w for w in rest], add_special_tokens=False) if rest else []
        found.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(rest, encoded))
        return found

    def _spans_of(self, words: list[str], before: str) -> dict[str, tuple[int, bytes, bytes]]:
        """Token counts and spans, counted from the start of what is encoded."""
        bare, stems, tails = self._without_tails(words, self.spans) if before == self.before else (words, {}, {})
        out = {}
        encoded = self.tokenizer.encode_batch([before + w for w in bare], add_special_tokens=False) if bare else []
        for w, e in zip(bare, encoded):
            spans = np.array(e.offsets, "<i4").reshape(-1, 2)
            out[w] = (len(spans), spans[:, 0].tobytes(), spans[:, 1].tobytes())
        for w, stem in tails.items():
            n, starts, ends = out.get(stem) or stems[stem]
            at = len(before) + len(stem)
            out[w] = (n + 1, starts + at.to_bytes(4, "little"), ends + (at + 1).to_bytes(4, "little"))
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and vocabulary."""
    return WordEncoder(path)
