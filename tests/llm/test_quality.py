import math
import random

import numpy as np

from samples import prose
from docmonitor.llm import gam, quality_rules


def counts_by_hand(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_base_counts():
    r = random.Random(3)
    texts = ["", "a", "a b c d e a b c d e", "x y\nx y\n\n x y\nx y", "é|ü ***\x0b日本 \x85 \xa0z"]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) + "\n" * r.randint(0, 3) for _ in range(40)]
    for text in texts:
        data = text.encode()
        assert quality_rules.base_counts(data, data.split()) == counts_by_hand(text), text


def test_verdicts(documents, mixed_rows):
    rows = [(1000 + i, prose(i, 150), "en", "s") for i in range(150)]
    junk = " ".join(w.upper() + "!!###$$$" for w in prose(77, 200).split())
    table = " | ".join(w + str(k) for k, w in enumerate(prose(78, 200).split()))
    rows += [(1, junk, "en", "s"), (2, table, "en", "s"), (3, "too short", "en", "s"), (4, None, None, None), (5, "", "en", "s")]
    got = {r["doc_id"]: r for r in quality_rules.judge(documents(rows + [(i and i + 5000, *x) for i, *x in mixed_rows])).collect()}
    assert all(got[1000 + i]["kept"] for i in range(150))
    assert not any(got[i]["kept"] for i in (1, 2, 3, 4, 5))
    assert [got[i]["base_failed"] for i in (1, 2, 3, 4, 5)] == [False, False, True, True, True]
    for i, text, *_ in rows:
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts_by_hand(text)


def test_kept_columns_and_empty_table(documents, mixed_rows):
    docs = documents(mixed_rows)
    out = quality_rules.judge(docs, keep_columns=True)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == len(mixed_rows)
    assert quality_rules.judge(documents([])).collect() == []


def test_clean_documents_of_a_rare_language(documents):
    """A language under the least number of words has no reference, and the others' words don't judge it."""
    r = random.Random(5)
    rare = " ".join(r.choice("huis boom water fiets straat brood winter kaas molen lucht".split()) for _ in range(70))
    docs = documents([(i, prose(i, 1000), "en", "s") for i in range(40)] + [(100, rare, "nl", "s"), (101, rare, "en", "s")])
    got = {x["doc_id"]: x for x in quality_rules.judge(docs).collect()}
    assert got[100]["kept"] and got[100]["word_distance"] is None and got[100]["char_distance"] is not None
    assert not got[101]["kept"] and got[101]["word_distance"] > quality_rules.MOST_WORD_DISTANCE
    assert all(got[i]["kept"] and got[i]["word_distance"] is not None for i in range(40))
    langs = lambda least: sorted(r["lang"] for r in quality_rules.references(docs, least).collect())
    assert langs(quality_rules.REFERENCE_WORDS) == ["en"] and langs(70) == ["en", "nl"]


def classes_by_hand(text):
    out = np.zeros(6)
    for b in (text or "").encode():
        c = chr(b)
        if c in " \t\n\x0b\x0c\r":
            continue
        out[0 if "a" <= c <= "z" or b >= 128 else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9"
            else 3 if c in ".,;:!?'\"-()" else 4 if c in "#*$%&|<>" else 5] += 1
    return out


def plain_by_hand(text):
    marks = "".join(chr(i) for i in range(128) if not chr(i).isalnum() and chr(i) not in " \t\n\x0b\x0c\r")
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w.strip(marks) for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", lower)]


def distance_by_hand(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda a, b: sum(u * math.log2(2 * u / (u + v)) for u, v in zip(a, b) if u)
    return math.sqrt(max(0.0, (kl(p, q) + kl(q, p)) / 2))


def test_distances_and_verdicts_by_hand(documents, mixed_rows):
    """References, distances and verdicts against a plain count; blocks of languages change nothing."""
    rows = [(1000 + i, prose(i, 150), ("en", "fr")[i % 2], "s") for i in range(20)]
    rows += [(2000 + i, " ".join(w[::-1] for w in prose(i, 90).split()), f"l{i % 4}", "s") for i in range(12)]
    junk = " ".join(w.upper() + "!!###$$$" for w in prose(77, 200).split())
    rows += [(1, junk, "en", "s"), (2, junk, None, "s"), *((i and i + 5000, *x) for i, *x in mixed_rows if i not in (103, 107))]
    texts = {}
    for _, text, lang, _ in rows:
        if lang is not None:
            texts.setdefault(lang, []).append(text)
    refs = {}
    for lang, of in texts.items():
        words = __import__("collections").Counter(w for t in of for w in plain_by_hand(t))
        if sum(words.values()) >= 100:
            top = sorted((-n, w.encode()) for w, n in words.items() if w)[:100]
            rest = sum(words.values()) - words[""] + sum(n for n, _ in top)
            refs[lang] = sum(map(classes_by_hand, of)), {w.decode(): k for k, (_, w) in enumerate(top)}, [*(-n for n, _ in top), words[""], rest]
    want = {}
    for i, text, lang, _ in rows:
        n_words, *_, repeated = counts_by_hand(text)
        near = None, None
        if n_words >= 10 and 100 * repeated <= 20 * n_words and classes_by_hand(text).sum() >= 200:
            for chars, common, counts in refs.values():
                c, w = distance_by_hand(classes_by_hand(text), chars), None
                if n_words >= 50 and (lang is None or lang in refs):
                    own = [0] * len(counts)
                    for word in plain_by_hand(text):
                        own[-2 if not word else common.get(word, -1)] += 1
                    w = distance_by_hand(own, counts)
                if near[0] is None or c + (w or 0) < near[0] + (near[1] or 0):
                    near = c, w
        want[i] = (*near, not (n_words < 10 or 100 * repeated > 20 * n_words) and (near[0] or 0) <= 0.30 and (near[1] or 0) <= 0.54)
    assert len(refs) == 6 and {k for _, _, k in want.values()} == {True, False}
    for block in (500, 2):
        got = {r["doc_id"]: r for r in quality_rules.judge(documents(rows), least_words=100, block=block).collect()}
        assert set(got) == set(want)
        for i, (c, w, kept) in want.items():
            assert got[i]["kept"] == kept, i
            for name, value in (("char_distance", c), ("word_distance", w)):
                assert (got[i][name] is None) == (value is None) and abs((got[i][name] or 0) - (value or 0)) < 1e-9, (i, name)


def test_jensen_shannon_distance():
    p, q = np.array([1.0, 0, 3]), np.array([1.0, 1, 2])
    a, b = p / 4, q / 4
    kl = lambda x, m: sum(u * math.log2(u / v) for u, v in zip(x, m) if u)
    m = (a + b) / 2
    assert abs(quality_rules.distance(p, q) - math.sqrt((kl(a, m) + kl(b, m)) / 2)) < 1e-12
    assert quality_rules.distance(p, p) == 0 and quality_rules.distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1


def test_model_learns_single_features_and_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(gam.FEATURES)))
    y = (((x[:, 0] > 0.3) & (x[:, 1] < 0.8)) ^ ((x[:, 2] > 0.5) & (x[:, 3] > 0.5) & (x[:, 0] > 0.3))).astype(float)
    model = gam.fit(x[:3000], y[:3000], rounds=60)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert (2, 3) in model.pairs
    by_hand = model.base + sum(t[np.searchsorted(c, x[0, j], "right")] for j, (c, t) in enumerate(zip(model.cuts, model.tables)))
    by_hand += sum(t[tuple(np.searchsorted(model.pair_cuts[k], x[0, k], "right") for k in pair)] for pair, t in model.pairs.items())
    assert abs(model.margin(x[:1])[0] - by_hand) < 1e-9


def test_classifier_on_documents(shared, documents, mixed_rows):
    rows = [(i, prose(i, 80) if i % 3 else " ".join(w.upper() + "!!" for w in prose(i, 80).split()), "en", "s") for i in range(400)]
    labels = shared.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)] + [(5, None, 0), (None, 1, 1), (6, 1, 0)],
                                    "doc_id long, quality int, toxic int")
    docs = documents(rows)
    x, y = gam.training_rows(docs, labels)
    assert 200 < len(y) < 400
    x2, _ = gam.training_rows(docs, labels, sample_rows=50)
    assert len(x2) == 50
    got = gam.score(docs, gam.fit(x, y)).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    assert all(r["predicted"] == (r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in held)
    odd = gam.score(documents(mixed_rows), gam.fit(x, y)).collect()
    assert len(odd) == len(mixed_rows) and all(0 <= r["score"] <= 1 for r in odd)


def test_model_without_labels(shared, documents):
    labels = shared.createDataFrame([], "doc_id long, quality int")
    model = gam.fit(*gam.training_rows(documents([(1, "a", "en", "s")]), labels))
    assert [r["score"] for r in gam.score(documents([(1, "a", "en", "s"), (2, None, None, None)]), model).collect()] == [0.5, 0.5]
    assert gam.score(documents([]), model).collect() == []
