"""Token files, packing and token counts against the tokenizer itself."""

import io
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docmonitor.llm import dac, packing, token_counts, tokens
from docmonitor.llm.common import tokenizer_path
from docmonitor.session import scratch_path

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = ["", " ", "a", "  a  b ", "a\n\n b\tc  d\n", "x\x1fy z\x1c w", "é ̈a ü  ñ", "a<|endoftext|>b <|endoftext|> c", "'S it's  I'll.",
       "\n\n", "日本語 テスト　漢字", "a" * 5000 + " b", "👍🏽 ok   x y z", "ha.\nTion, x. ., a. .,b", "\x01 a\x01b \x01"]


@pytest.mark.parametrize("name", FILES)
def test_words_give_the_ids_of_whole_texts(name, mixed_rows):
    code, plain = tokens.WordEncoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    texts = ODD + [t for _, t, *_ in mixed_rows if t] + ODD
    want = [plain.encode(t, add_special_tokens=False) for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in code.encode_many(texts)] == [e.ids for e in want]
    spans = code.spans_many(texts)
    assert [list(zip(a.tolist(), b.tolist())) for a, b in spans] == [e.offsets for e in want]


ODD_STARTS = ["\n.x a", "ab a", "\n<|endoftext|>y a", "\t<|endoftext|>", "\n", "\nq", "<|endoftext|>y", "cd e", "\r\n.z b", "\x01n a", "\x0bk a"]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("seed", range(8))
def test_first_words_may_be_white_space(name, seed):
    """In one batch and in any order, so that no word gets its neighbour's ids."""
    plain, r = Tokenizer.from_file(tokenizer_path(name)), random.Random(seed)
    texts = ODD_STARTS * 2 + ["".join(r.choice(["\n", " ", "\t", "a", "b.", "<|endoftext|>", ",", "\r", "\x01", "é", "\u0130.", "\x85"])
                                      for _ in range(r.randint(0, 7))) for _ in range(2500)]
    r.shuffle(texts)
    want = plain.encode_batch(texts, add_special_tokens=False)
    for start in range(0, len(texts), 50 if seed % 2 else len(texts)):
        code = tokens.encoder(tokenizer_path(name)) if seed % 4 < 2 else tokens.WordEncoder(tokenizer_path(name))
        part, e = texts[start:start + 50] if seed % 2 else texts, want[start:start + 50] if seed % 2 else want
        assert [np.frombuffer(b, "<u4").tolist() for b in code.encode_many(part)] == [x.ids for x in e]
        assert [list(zip(a.tolist(), b.tolist())) for a, b in code.spans_many(part)] == [x.offsets for x in e]


@pytest.mark.parametrize("name", FILES)
def test_stops_behind_every_letter(name):
    """Letters that the normalizer turns into a letter and a mark keep the stop with the mark."""
    code, plain = tokens.WordEncoder(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    apart = "\u0130\u0958\u095f\u09dc\u0a33\u0b5c\u0f43\ufb1d\ufb2a\ufb4e"
    letters = apart + "".join(chr(c) for c in range(0x3000) if chr(c).isalpha()) + "\ud55c\u1112\u1161\u11ab\U00010400\U0001e900"
    texts = [f"{a}{c}{tail} b{c}{tail}" for c in letters for a in ("", "x") for tail in ".,"]
    want = plain.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(b, "<u4").tolist() for b in code.encode_many(texts)] == [e.ids for e in want]
    spans = code.spans_many(texts)
    assert [list(zip(a.tolist(), b.tolist())) for a, b in spans] == [e.offsets for e in want]


def test_the_cache_stays_within_its_bound(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    code, plain = tokens.WordEncoder(tokenizer_path(FILES[1])), Tokenizer.from_file(tokenizer_path(FILES[1]))
    for k in range(40):
        text = " ".join(f"w{i * k % 97}." for i in range(30))
        assert np.frombuffer(code.encode_many([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(code.ids.new) + len(code.ids.old) < 200


class Buffer(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_any_token_is_read_alone(n):
    r = random.Random(n)
    ids = np.array([r.choice([3, 255, 256, 49407, 1 << 16, (1 << 32) - 1, r.randrange(1 << 20)]) for _ in range(n)], "<u4")
    file = Buffer()
    dac.write_file(file, [(4, 0), (None, min(n, 3))], ids)
    read = dac.DacFile(file)
    assert read.tokens(0, n).tolist() == ids.tolist()
    assert [read.token(i) for i in range(0, n, 7)] == ids[::7].tolist()
    for _ in range(30):
        a = r.randint(0, n)
        b = r.randint(a, n)
        assert read.tokens(a, b).tolist() == ids[a:b].tolist()
    assert read.documents()[0] == [4, None]
    with pytest.raises(IndexError):
        read.tokens(0, n + 1)


def test_token_files_come_back(shared, documents, mixed_rows):
    path = tokenizer_path(FILES[0])
    manifest = dac.write_tokens(documents(mixed_rows), scratch_path(shared, "t"), path, 2, file_tokens=3000)
    got = sorted(dac.read_tokens(manifest).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(path)
    want = sorted((-1 if i is None else i, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)) for i, ids in (
        (i, plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, *_ in mixed_rows))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids_crc32"], r["n_tokens"]) for r in got) == want
    numbers = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert numbers == sorted(numbers)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert manifest.count() > 3


def test_token_files_of_nothing(shared, documents):
    manifest = dac.write_tokens(documents([]), scratch_path(shared, "t"), tokenizer_path(FILES[0]), 2)
    assert dac.read_tokens(manifest).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_tightest_bin(seed):
    r = random.Random(seed)
    lengths = np.array([r.randint(1, 100) for _ in range(300)])
    bins, offsets = packing.best_fit_decreasing(lengths, 100)
    rooms = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):  # plain best fit
        fits = [room for room in rooms if room >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(100 - lengths[i])
    assert len(set(bins)) == len(rooms)
    for b in set(bins):
        inside = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert inside[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(inside, inside[1:]))
        assert sum(n for _, n in inside) <= 100


def test_packing(documents, mixed_rows):
    path = tokenizer_path(FILES[1])
    rows = packing.pack(packing.token_pieces(documents(mixed_rows), path, 0), group_tokens=60_000).collect()
    plain = Tokenizer.from_file(path)
    want = []
    for i, t, *_ in mixed_rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0] + list(range(first, len(ids) + 1, 2048))
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in sequences.values():
        inside.sort()
        assert inside[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(inside, inside[1:]))
        assert sum(n for _, n in inside) <= 2048
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 2048) + -(-total // 60_000)


def test_packing_of_nothing(documents):
    assert packing.pack(packing.token_pieces(documents([]), tokenizer_path(FILES[1]), 0)).collect() == []


def test_token_counts(documents, mixed_rows):
    path = tokenizer_path(FILES[1])
    plain = Tokenizer.from_file(path)
    got = {}
    for r in token_counts.token_counts(documents(mixed_rows), path).collect():
        got.setdefault(r["doc_id"], []).append((r["section"], r["char_start"], r["char_end"], r["n_tokens"]))
    for i, t, *_ in mixed_rows:
        t = t or ""
        lines = [x + "\n" for x in t.split("\n")[:-1]] + [t.split("\n")[-1]]
        starts = np.cumsum([0] + [len(x) for x in lines]).tolist()
        sections = [(a, b) for a, b in zip(starts, starts[1:]) if b > a] or [(0, 0)]
        counts = [0] * len(sections)
        for s, e in plain.encode(t, add_special_tokens=False).offsets:
            counts[max(range(len(sections)), key=lambda k: (min(e, sections[k][1]) - max(s, sections[k][0]), -k))] += 1
        want = [(k, *ab, n) for k, (ab, n) in enumerate(zip(sections, counts))]
        assert sorted(set(got[i])) == want, (i, t[:50])


def test_boundary_rule():
    spans = np.array([[0, 2], [2, 6], [6, 10], [10, 10]])
    n, crossing = token_counts.attribute(spans[:, 0], spans[:, 1], np.array([0, 4, 9]))
    assert n.tolist() == [2, 1, 1] and crossing.tolist() == [1, 1, 0]


def test_signs_and_lines_are_no_new_words(monkeypatch):
    """A known word before signs or a line end isn't encoded again; the ids stay those of the whole text."""
    path = tokenizer_path("byte_bpe_50k.json")
    encoder, asked = tokens.WordEncoder(path), []
    encode = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda words, *a: asked.extend(words) or encode(words, *a))
    encoder.encode_many(["x querious zobbling"])
    asked.clear()
    text = "x querious%%% zobbling.\nThen querious!? zobbling\nquerious"
    (ids,) = encoder.encode_many([text])
    assert ids == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert set(asked) <= {"x", "%%%", "!?", ".", "Then", "querious"} and asked.count("querious") == 1  # behind the line end
