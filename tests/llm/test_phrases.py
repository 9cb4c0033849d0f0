"""Phrase mining against counting by hand."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from docmonitor.llm import phrases

PIECES, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
A_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_hand(rows, longest=3, least=10, part=50, per_language=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in PIECES.split((text or "").translate(A_Z)):
            words = WORD.findall(piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    found = {}
    wanted = [g for g, a in counts.items() if a >= least and len(g) > 2]
    for g in wanted:
        lang, words, a = g[0], g[1:], counts[g]
        inside = [h for h in wanted if len(h) > len(g) and h[0] == lang and 100 * counts[h] >= part * a
                  and any(h[1 + i:1 + i + len(words)] == words for i in range(len(h) - len(g) + 1))]
        if not inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
                cuts.append((1000000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, totals[lang], -score) for lang, out in found.items()
            for rank, (score, a, p, left, right) in enumerate(sorted(out)[:per_language], 1)}


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mined(docs, **more):
    out = phrases.collocations(docs, **more)
    assert out.columns == list(COLUMNS)
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts(mixed_rows):
    r, words = random.Random(3), "A b c d É e\x1f ß Z| ab".split(" ")
    rows = []
    for i in range(150):
        line = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]) for _ in range(r.randint(0, 40)))
        rows.append((i, line, r.choice(["en", "en", None, "und", "fr"]), "s"))
    rows += [(200 + i, "one hot passage of words, one hot passage", "en", "s") for i in range(60)]
    return rows + mixed_rows


@pytest.mark.parametrize("chunk_words", [phrases.CHUNK_WORDS, 200])
def test_phrases(documents, texts, chunk_words):
    got = mined(documents(texts), chunk_words=chunk_words)
    assert got == by_hand(texts) and len({g[0] for g in got}) > 2 and len(got) > 100


def test_longer_phrases_and_few_of_them(documents, texts):
    options = {"longest": 4, "least": 4, "part": 70, "per_language": 9}
    assert mined(documents(texts), chunk_words=300, **options) == by_hand(texts, **options)


def test_words_never_share_a_number(documents, texts):
    rows = texts[:60]
    assert mined(documents(rows), bits=9, least=3) == by_hand(rows, least=3)  # some seeds make two words equal


def test_long_texts_are_read_in_slices(documents, monkeypatch):
    text = ("alpha beta gamma. " * 3 + "delta epsilon " * 50 + ", ") * 40
    folded = text.encode().translate(phrases.FOLD)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 100)
    parts = list(phrases.slices(folded))
    assert len(parts) > 40 and b"".join(parts) == folded and all(p.endswith(b".") for p in parts[:-1])
    assert list(phrases.slices(b"")) == []
    assert mined(documents([(1, text, "en", "s")])) == by_hand([(1, text, "en", "s")])


def test_phrases_of_nothing(documents):
    assert mined(documents([])) == set()
    assert mined(documents([(1, None, None, None), (2, "", "en", "s"), (3, " .,\n", "en", "s")])) == set()


def test_few_bits_tell_frequent_words_apart(spark):
    named = spark.createDataFrame([(i << 40 | i, 0, 10, 0) for i in range(-20, 20)], "w1 long, more long, a long, chunk long")
    assert phrases.enough_bits(named, 64) == 16  # 40 words
    high = spark.createDataFrame([(i << 40 | 5, 0, 10, 0) for i in range(40)], "w1 long, more long, a long, chunk long")
    assert phrases.enough_bits(high, 64) == 46 and phrases.enough_bits(high, 30) == 0


def test_numbers_of_groups_are_short(documents, texts):
    groups, _, bits = phrases.frequent_groups(phrases.occurrences(documents(texts)))
    words = [r.w1 for r in groups[1].collect()]
    assert len(words) == len(set(words)) and bits < 30 and max(words) < 1 << bits
    assert {w for r in groups[2].collect() for w in (r.w1, r.w2)} <= set(words)


def test_rare_groups_stay_with_their_chunks(documents, texts, monkeypatch):
    """What reaches the shuffle of groups has a frequent hash: nearly nothing else, from chunks that all have little."""
    counted, kept = phrases._count_groups, []

    def count(*args):
        kept.append(counted(*args))
        return kept[-1]

    monkeypatch.setattr(phrases, "_count_groups", count)
    monkeypatch.setattr(phrases, "SUMMED_GROUPS", 500)  # several buckets
    assert mined(documents(texts), chunk_words=200) == by_hand(texts)
    for rows in kept:
        totals = Counter()
        for *_, words, n in [(tuple(r)[2:-1], r.n) for r in rows.collect()]:
            totals[words] += n
        assert totals and min(totals.values()) >= 10


def test_frequent_groups_make_one_row(documents, texts, monkeypatch):
    """A group that is frequent in many chunks leaves the count as one row, with the count of all of them."""
    counted, kept = phrases._count_groups, []

    def count(*args):
        kept.append(counted(*args))
        return kept[-1]

    monkeypatch.setattr(phrases, "_count_groups", count)
    monkeypatch.setattr(phrases, "SUMMED_GROUPS", 500)
    chunks = phrases.occurrences(documents(texts), 200)
    assert chunks.where("lang = 'en'").count() > 10
    phrases.frequent_groups(chunks)
    hand = Counter()
    for _, text, lang, _ in texts:
        for piece in PIECES.split((text or "").translate(A_Z)):
            words = WORD.findall(piece)
            hand.update((lang or "und", *words[i:i + m]) for m in (2, 3) for i in range(len(words) - m + 1))
    for m, rows in zip((2, 3), kept):
        rows = rows.collect()
        assert len(rows) == len({tuple(r)[2:-1] for r in rows})
        assert sorted(r.n for r in rows) == sorted(a for g, a in hand.items() if len(g) == m + 1 and a >= 10)


def test_answers_of_shuffled_chunks(documents, texts, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_ANSWERS", -1)
    monkeypatch.setattr(phrases, "SUMMED_GROUPS", 300)
    assert mined(documents(texts), chunk_words=500) == by_hand(texts)


def test_answers_to_blocks(spark):
    """Sums by key and further bits, large ones too; a word's second half may tell it apart."""
    r = random.Random(5)
    pool = [(r.choice([r.getrandbits(64), 7, 1 << 63, (1 << 64) - 1]), r.choice([0, 9, r.getrandbits(64)])) for _ in range(300)]
    chunks = {c: {g: r.randint(1, 6) for g in r.sample(sorted(set(pool)), 150)} for c in (3, 1, 8)}
    buckets, rows, dealt = 5, [], {}
    for c, own in chunks.items():
        keys, more = (np.array([g[i] for g in own], np.uint64) for i in (0, 1))
        order, ends = phrases._dealt(keys, more, buckets)
        dealt[c] = [list(own)[i] for i in order]
        for batch in phrases._blocks(c, keys[order], more[order], np.array(list(own.values()))[order], ends):
            rows += batch.to_pylist()
    totals = sum((Counter(own) for own in chunks.values()), Counter())
    wanted = {g: a for g, a in totals.items() if a >= 8}
    blocks = spark.createDataFrame([tuple(x.values()) for x in rows], phrases._ddl(phrases.BLOCK))
    answers = phrases._answers(blocks, 8, buckets, "answers")
    got, names = [x.asDict() | {"level": 1} for x in answers.collect()], {}
    for c in sorted(chunks):
        own = [x for x in got if x["chunk"] == c]
        numbers = phrases._numbers(own, 1, buckets)
        assert len(numbers) == len(dealt[c])
        for g, number in zip(dealt[c], numbers.tolist()):
            assert (number >= 0) == (g in wanted) and (number < 0 or names.setdefault(g, number) == number)
    signed = lambda x: x - (1 << 64 if x >> 63 else 0)
    assert len(set(names.values())) == len(wanted)
    assert sorted(tuple(x) for x in phrases._found(answers, buckets).collect()) == sorted(
        (min(c for c in chunks if g in chunks[c]), names[g], *map(signed, g), a) for g, a in wanted.items())


def test_blocks_are_short():
    """Pairs of numbers of 16 bits take little more than the steps between them."""
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 20_000).astype(np.uint64))
    (batch,) = phrases._blocks(1, keys, keys[:0], np.ones(len(keys), np.int64), [0, len(keys)])
    row = batch.to_pylist()[0]
    assert row["size"] == len(keys) and len(row["keys"]) + len(row["counts"]) < 3 * len(keys)
    assert (np.cumsum(phrases._unpacked(row["keys"], np.uint64, len(keys)), dtype=np.uint64) == keys).all()
