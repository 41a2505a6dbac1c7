"""Personal data, quality, sentence pieces and packing."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import packing_ga, piece_codec, positive_unlabelled, weak_pii
from orderlens.llm.queries import packing_of
from tests.llm.helpers import documents, found, prose, texts

MODEL, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def luhn(number):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def only(text):
    return re.sub("[^0-9]", "", text)


PLAIN = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(only(m)) <= 19 and luhn(only(m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(only(m)) <= 15),
]

PRIVATE = [
    "mail a.b@c.de, x_y@z.co.uk; a@b.c@d.e a@b.c_d@e.f @x.y q@ r@s %+-@a.b.",
    "ip 1.2.3.4.5.6.7.8 256.1.1.1 010.0255.000.9 9.9.9 é1.1.1.1é 1.2.3.4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5 12 1234567890123456789012 " + "4 " * 16,
    "tel +1 (375) 555-4393 +49-30-123456. ++441234567890) +1 2 +12345678901234567 + 12345678",
    "\U0001f600 +1 (375) 555-4393 a@b.cd\U0001f600 4111111111111111",
    "no digits", "jane (at) mail (dot) com or (212) 555-0199", "1" * 3000 + "." + "a" * 3000 + "@", "0 " * 3000,
    *texts(),
]


def test_base_spans_match_the_plain_patterns(spark):
    rows = list(enumerate(PRIVATE))
    got = found(weak_pii.personal_data(documents(spark, rows)))
    assert len(got) == len(rows)
    for i, text in rows:
        expected = [
            (k, m.start(), m.end()) for k, (p, ok) in enumerate(PLAIN) for m in re.finditer(p, text or "") if ok(m.group())
        ]
        spans = [(s.kind, s.start, s.end) for s in got[i].spans if s.base]
        assert spans == expected, text
        added = [(s.start, s.end) for s in got[i].spans if not s.base]
        assert all(e <= s or f <= t for t, e in added for _, s, f in expected if not (f <= t or e <= s)) and all(e > s for s, e in added)


def test_personal_data_of_awkward_tables(spark):
    assert weak_pii.personal_data(documents(spark, [])).count() == 0
    got = weak_pii.personal_data(documents(spark, [(None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd 1.2.3.4"), (3, None)])).collect()
    assert sorted((str(r.id), len(r.spans)) for r in got) == [("3", 0), ("3", 1), ("3", 2), ("None", 1)]


def test_redaction(spark):
    docs = documents(spark, [(1, "é a@1.2.3.4.com x +1 (375) 555-4393"), (2, "none"), (3, None)])
    got = weak_pii.personal_data(docs, keep=["text"])
    text = {r.id: r.t for r in got.select("id", weak_pii.redacted(F.col("row_data.text"), F.col("cuts")).alias("t")).collect()}
    assert text == {1: "é [EMAIL] x [PHONE]", 2: "none", 3: None}


def test_em_finds_the_unreliable_labeler():
    counts = {(0, 1, 1, 1, 1, 1): 500, (0, 1, 1, -1, 1, 1): 480, (0, -1, -1, 1, -1, -1): 470, (0, -1, -1, -1, -1, -1): 520}
    chance = weak_pii.reliabilities(counts)
    assert all((chance[k] > 0.9) == (k[1] == 1) for k in counts)


def test_plans_of_personal_data_hold_no_python(spark, sf_dir):
    df = weak_pii.personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def good_and_bad(n):
    rng = np.random.default_rng(5)
    return [(k, prose(k, 40).capitalize() + "." if rng.random() < 0.8 else "!! ".join(prose(k, 40).upper().split())) for k in range(n)]


def test_quality_tells_bad_texts_from_good_ones(spark):
    rows = good_and_bad(1500)
    bad = {i for i, t in rows if "!!" in t}
    positives = spark.createDataFrame([(i,) for i, _ in rows if i not in bad and i % 3 == 0], "doc_id long")
    judged = spark.createDataFrame([(i,) for i, _ in rows if i % 3 == 0], "doc_id long")
    got = found(positive_unlabelled.quality_scores(documents(spark, rows), positives, judged, fit_on=F.col("id") % 5 != 0))
    held = [i for i, _ in rows if i % 5 == 0]
    right = [(got[i].score >= 0.3) == (i not in bad) for i in held]
    assert len(got) == len(rows) and np.mean(right) >= 0.95


def test_quality_of_awkward_tables(spark):
    ids = spark.createDataFrame([(5,), (6,), (None,), (5,)], "doc_id long")
    docs = documents(spark).unionByName(documents(spark, [(None, "x"), (5, "y")]))
    got = positive_unlabelled.quality_scores(docs, ids).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert positive_unlabelled.quality_scores(documents(spark, []), ids).count() == 0
    assert {r.score for r in positive_unlabelled.quality_scores(docs, ids.limit(0)).collect()} == {0.5}
    # With every document judged, all of them are the other side.
    every = docs.select("doc_id")
    assert len({r.score for r in positive_unlabelled.quality_scores(docs, ids, every).collect()}) > 1


def test_features_of_many_slices_are_those_of_one(monkeypatch):
    whole = positive_unlabelled.features(pa.array(texts()))
    monkeypatch.setattr(positive_unlabelled.slices, "__defaults__", (50,))
    assert np.allclose(whole, positive_unlabelled.features(pa.array(texts())))


def test_pieces_are_the_library_s_and_spans_cover_the_source(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = list(enumerate(texts()))
    got = found(piece_codec.encoded(documents(spark, rows), MODEL))
    for i, text in rows:
        ids = library.encode(text or "")
        r = got[i]
        assert r.ids == ids and r.decoded == (library.decode(ids) if ids else "")
        data = (text or "").encode()
        assert len(r.starts) == len(r.ends) == len(ids)
        assert b"".join(data[s:e] for s, e in zip(r.starts, r.ends)) == data
    assert piece_codec.encoded(documents(spark, []), MODEL).count() == 0


def char_map(pairs):
    """A compiled map: a double array over byte strings, built by trial."""
    texts, places = b"", {}
    for key, value in pairs.items():
        places[key] = len(texts)
        texts += value + b"\0"
    units, used = {0: 0}, {0}
    todo = [(0, b"")]
    while todo:
        node, prefix = todo.pop()
        labels = sorted({k[len(prefix)] for k in pairs if k.startswith(prefix) and len(k) > len(prefix)})
        leaf = prefix in pairs
        base = next(b for b in range(1, 1 << 12) if all((node ^ b ^ c) not in used for c in [*labels, *([0] if leaf else [])]))
        units[node] = units.get(node, 0) | base << 10 | (leaf << 8)
        if leaf:
            units[node ^ base] = places[prefix] | 1 << 31
            used.add(node ^ base)
        for c in labels:
            units[node ^ base ^ c] = c
            used.add(node ^ base ^ c)
            todo.append((node ^ base ^ c, prefix + bytes([c])))
    array = np.zeros(max(units) + 256, "<u4")
    for k, v in units.items():
        array[k] = v
    return (len(array) * 4).to_bytes(4, "little") + array.tobytes() + texts


def test_longest_prefix_in_the_character_map_keeps_the_source():
    with open(MODEL, "rb") as file:
        codec = piece_codec.PieceCodec(file.read())
    codec.chars = piece_codec.CharMap(char_map({b"A": b"a", b"AB": b"xyz", "é".encode(): b"e", b"\t": b" ", b"Q": b""}))
    codec.identity = False
    norm, source = codec.normalised("AB A\té Qb")
    assert norm == "▁xyz▁a▁e▁b"
    assert source.tolist() == [0, 0, 0, 0, 0, 0, 2, 2, 2, 3, 4, 4, 4, 5, 7, 7, 7, 9, 10]
    ids, starts, ends = codec.encode("AB A\té Qb")
    assert ids == codec.segmenter.encode(norm) and starts[0] == 0 and ends[-1] == 10
    codec.squeeze = True
    assert codec.normalised("  A \t b  ")[0] == "▁a▁b" and codec.normalised(" \t ")[0] == ""


def check_packing(rows, pieces, capacity, tokens):
    places = {}
    for r in pieces:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert all(parts[k][0] == sum(n for _, n in parts[:k]) for k in range(len(parts)))
        assert sum(n for _, n in parts) <= capacity
    expected = sorted((i, p, a, zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes())) for i, ids in tokens for p, a in enumerate(range(0, len(ids), capacity)))
    assert sorted((r.doc_id, r.piece, r.start, r.ids_crc32) for r in pieces) == expected
    return len(places)


def test_packing_is_gapless_and_near_the_bound(spark):
    rows = list(enumerate([*texts(), *[prose(k, 20 + 13 * k % 900) for k in range(300)]]))
    tokenizer = Tokenizer.from_file(BPE)
    tokens = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    used = check_packing(rows, packing_of(documents(spark, rows)).collect(), 2048, tokens)
    assert used <= -(-sum(len(t) for _, t in tokens) // 2048) + 1


def test_packing_of_awkward_tables(spark):
    assert packing_of(documents(spark, [])).count() == 0
    got = packing_of(documents(spark, [(3, None), (3, None), (3, "a"), (4, "")])).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(3, 1), (3, 1), (3, 2), (4, 1)] and len({r.sequence_id for r in got}) == 1


def test_crossover_keeps_a_valid_packing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 500)
    people = packing_ga.evolved(lengths, [], 100, 1)
    for seed in range(5):
        child = packing_ga.crossed(lengths, people[0], people[-1], 100, np.random.default_rng(seed))
        assert np.bincount(child, lengths).max() <= 100 and (child >= 0).all()


def test_plain_words_are_encoded_many_in_one_call():
    """Batches meet no word's neighbour, and the model is not called word by word."""
    rng = np.random.default_rng(4)
    words = sorted({"".join(rng.choice(list("abcdefghijéßñıŉ"), rng.integers(1, 9))) for _ in range(12_000)})
    own, calls = packing_ga.WordIds(BPE), []

    class Counted:
        def __init__(self, model):
            self.model = model

        def encode(self, *args, **options):
            calls.append(1)
            return self.model.encode(*args, **options)

    own.model = Counted(own.model)
    bounds, ids = own.encode(pa.array(words))
    whole = Tokenizer.from_file(BPE)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(w, add_special_tokens=False).ids for w in words]
    assert 0 < len(calls) <= -(-len(words) // 5000)


def test_letters_with_marks_leave_the_whole_tokenizer_alone(monkeypatch):
    """Capitals and signs behind letters of two bytes are split off; the rest is the model's."""
    rng = np.random.default_rng(5)
    stems = {"".join(rng.choice(list("abéßñÉÀÇ"), rng.integers(2, 7))) for _ in range(3_000)}
    words = sorted(w + str(rng.choice(["", ".", ",%%%", "!?"])) for w in stems)
    own, others = packing_ga.WordIds(BPE), []

    class Counted:
        def __init__(self, whole):
            self.whole = whole

        def encode(self, text, **options):
            others.extend(text.split(" | "))
            return self.whole.encode(text, **options)

    own.tokenizer = Counted(own.tokenizer)
    # Two calls of few kept words: some are met again in the older generation, some are learnt again.
    monkeypatch.setattr(packing_ga, "KEPT_WORDS", 1_000)
    whole = Tokenizer.from_file(BPE)
    for part in (words, words[::-1], words[::7]):
        bounds, ids = own.encode(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole.encode(w, add_special_tokens=False).ids for w in part]
    assert not [w for w in others if w[:1].isalpha()]


@pytest.mark.parametrize("text", ["I\u0307\u0327 x", "ÉÀ× ×é.é's É'll ɐ.ɏ", "é\u0301. E\u0301! ÿ\u0327ŉ", "ǅ.Ǆ, ẞß Σς."])
def test_word_ids_of_letters_with_marks(text):
    bounds, ids = packing_ga.WordIds(BPE).encode(pa.array([text, None, text]))
    want = Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want * 2 and bounds.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_whole_sequences_carry_their_ids(spark):
    docs = documents(spark, [(1, "a b c"), (2, "d e")])
    pieces = packing_ga.token_pieces(docs, BPE, 4).withColumn("length", F.size("ids").cast("long"))
    got = packing_ga.sequences(packing_ga.packed(pieces, 4)).collect()
    ids = Tokenizer.from_file(BPE).encode("a b c d e", add_special_tokens=False).ids
    assert sorted(sum((r.ids for r in got), [])) == sorted([*ids, 0, 0]) and max(len(r.ids) for r in got) <= 4


@pytest.mark.parametrize("text", [t for t in texts() if t])
def test_word_ids(text):
    tokenizer = Tokenizer.from_file(BPE)
    bounds, ids = packing_ga.WordIds(BPE).encode(pa.array([text]))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids)]
