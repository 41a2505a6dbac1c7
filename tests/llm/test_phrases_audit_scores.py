"""Phrase collocations, the filter audit and language-model scores against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.llm import attention_lm, packing_ga, phrase_rollup, queries, radix_audit
from orderlens.llm.common import filled
from tests.llm.helpers import prose, texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, lang string, text string, phrase string, n long, mask int, part string, id string, words string, block string"


def table_of(spark, rows):
    """Documents whose other columns have names the operators use themselves."""
    return spark.createDataFrame([(i, lang, t, "p", 1, 3, "q", "x", "w", "b") for i, lang, t in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def phrases_by_hand(rows, longest=3, least=10, percent=50, first=2000):
    n, f = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + m])) for i in range(len(words)) for m in range(1, longest + 1) if i + m <= len(words))
    chosen = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    around = Counter()
    for (lang, p), a in chosen.items():
        for size in range(2, len(p)):
            for at in range(len(p) - size + 1):
                around[lang, p[at : at + size]] = max(a, around[lang, p[at : at + size]])
    ranked = defaultdict(list)
    for (lang, p), a in chosen.items():
        if 100 * around[lang, p] < percent * a:
            score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            ranked[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, at, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in ranked.items()
        for at, (score, a, p, left, right) in enumerate(sorted(rows)[:first], 1)
    )


def phrase_rows():
    rng = random.Random(4)
    words = ["New", "york", "city", "is", "big.", "Is,", "a\tb", "é", "漢字", "x\x0by", "\x85z"]
    rows = [(k, rng.choice(["en", "fr", None, "und", ""]), " ".join(rng.choices(words, k=60))) for k in range(60)]
    rows += [(k, "en", "hot pair of words! " * 40) for k in range(30)] + [(3, "en", "hot pair " * 2000)] * 2
    return rows + [(900 + k, "en", t) for k, t in enumerate(texts())] + [(None, "en", "new york city " * 12), (None, None, None)]


@pytest.mark.parametrize("options", [{}, {"longest": 2, "first": 3}, {"longest": 4, "least": 3, "percent": 80, "first": 40}])
def test_phrases(spark, options):
    rows = phrase_rows()
    named = {("covered_percent" if k == "percent" else k): v for k, v in options.items()}
    got = phrase_rollup.collocations(table_of(spark, rows), **named)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, **options)


def test_phrases_of_nothing(spark):
    assert phrase_rollup.collocations(table_of(spark, [])).count() == 0
    assert phrase_rollup.collocations(table_of(spark, [(1, "en", None), (2, None, " .,")])).count() == 0
    with pytest.raises(ValueError):
        phrase_rollup.collocations(table_of(spark, []), longest=1)


def test_phrase_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 123_456_789_012_345, 123_456_789_012_399, 987_654_321_098_765
    df = spark.createDataFrame([("en", "x", 10**15 - 1, 0), ("en", "x y", a, 0), ("en", "y", r, 0)], "lang string, window string, n long, k int")
    counts = {row["phrase"]: row["f"] for row in phrase_rollup.phrase_counts(df.select("lang", "window", "n"), 2).collect()}
    assert counts == {"": 10**15 - 1 + a + r, "x": 10**15 - 1 + a, "y": r, "x y": a}
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(
        "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as s"
    )
    assert row.first()["s"] == 1_000_000 * a * a // (l * r)


def failed_by_hand(rows):
    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, lang, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        hits = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t)]
        hits += [bool(re.search(r"[#$%&*|]", t)), i is not None and i > least.get(t, i)]
        out.append((lang or "", "".join(x for x, hit in zip("ABCDE", hits) if hit), i))
    return out


def audit_by_hand(rows, labels):
    marks = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        marks[i] = [max(marks[i][0], quality == 1), max(marks[i][1], toxic == 1)]
    counts = Counter((part, fails, *(marks[i] if i in marks and i is not None else (0, 0))) for part, fails, i in failed_by_hand(rows))
    sums, shapley = {}, Counter()
    for (part, fails, good, toxic), n in counts.items():
        for order in itertools.permutations("ABCDE"):
            for k, x in enumerate(order):
                row = sums.setdefault((part, "".join(order), k + 1), [0] * 6)
                earlier, hit = any(y in fails for y in order[:k]), x in fails
                removed = n * (hit and not earlier)
                for at, v in enumerate((n * (not hit and not earlier), removed, n * (hit and earlier), n * (fails == x), removed * good, removed * toxic)):
                    row[at] += v
                shapley[part, x] += removed
    return sorted((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in sums.items())


def audit_rows():
    long = prose(7, 260)
    rows = [(k, ["en", "fr", None, ""][k % 4], t) for k, t in enumerate(texts(), start=5)]
    rows += [(400 - k, "en", "one text many times") for k in range(150)] + [(20, "fr", "one text many times")] * 3
    rows += [(500 + k, "de", long + f" tail{k % 9}") for k in range(40)] + [(600 + k, "de", long[: 30 * k]) for k in range(40)]
    rows += [(700 + k, "es", "word " * k + "#" * (k % 2) + "A" * (k % 5)) for k in range(190, 210)]
    return rows + [(None, "en", "one text many times"), (None, None, None), (800, "en", "long " * 60_000), (801, "en", "long " * 60_000)]


def test_audit(spark, monkeypatch):
    rows, rng = audit_rows(), random.Random(1)
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in rows if rng.random() < 0.7] + [(None, 1, 1), (99_999, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    want = audit_by_hand(rows, marks)
    for range_bytes, local in ((300, 200), (1 << 25, 1 << 25)):
        monkeypatch.setattr(radix_audit, "LOCAL_BYTES", local)
        got = radix_audit.audited(table_of(spark, rows).repartition(3), labels, range_bytes=range_bytes)
        assert sorted(map(tuple, got.collect())) == want
    assert radix_audit.audited(table_of(spark, []), labels).count() == 0
    assert len(want) % 600 == 0


def test_ranges_are_cut_by_longer_prefixes_where_needed(spark):
    same = "boilerplate at the head of every text, " * 5
    rows = [same + f"{k:04d} own end" for k in range(400)] + ["copy " * 100] * 300 + [""]
    df = spark.createDataFrame([(t,) for t in rows], "text string").select(filled("text").cast("binary").alias("text"))
    starts = radix_audit.range_starts(df, 4_000)
    held = Counter(max(s for s in starts if s <= t.encode()) for t in rows)
    assert starts[0] == b"" and starts == sorted(set(starts))
    assert max(n for s, n in held.items() if s.startswith(b"boiler")) <= 20
    assert len([s for s in starts if s.startswith(b"copy")]) <= 1


def test_trie_keeps_texts_apart():
    trie, rng = radix_audit.RadixTrie(), random.Random(2)
    items = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(500)]
    nodes = [trie.insert(t) for t in items]
    assert len(set(zip(items, nodes))) == len(set(items)) == len(set(nodes))
    assert trie.held == sum(len(label) for label in trie.labels)


def test_scores(spark):
    rows = [(k, "en", t) for k, t in enumerate(texts() + [prose(50 + k, 90) for k in range(60)])]
    rows += [(7, "fr", "again"), (None, "fr", "no number"), (None, "fr", "no number")]
    got = attention_lm.scored(table_of(spark, rows).repartition(2), TOKENIZER)
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]) for i, _, t in rows]
    trains = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in tokens]
    counts = Counter(w for (_, words), used in zip(tokens, trains) if used for w in words)
    n, v = sum(counts.values()), len(counts)

    def key(row):
        return [(x is not None, x or 0) for x in row]

    want = sorted(
        [
            (i, not used, len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), 6))
            for (i, words), used in zip(tokens, trains)
        ],
        key=key,
    )
    found = got.collect()
    assert sorted([(*r[:5], round(r["base_score"], 6)) for r in found], key=key) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_scores_without_rows_and_without_training(spark):
    assert attention_lm.scored(table_of(spark, []), TOKENIZER).count() == 0
    rows = attention_lm.scored(table_of(spark, [(None, "en", "a b"), (None, "en", None)]), TOKENIZER).collect()
    assert [(r["held_out"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(True, 0, 0, 0.0)] * 2


def small_model(n=40, seed=3):
    rng = np.random.default_rng(seed)
    classes = attention_lm.Classes(rng.integers(0, 50, n).astype(float), rng.random(n) < 0.5)
    return classes, attention_lm.first_weights(classes), rng


def test_class_probabilities_sum_to_one_over_subwords():
    classes, w, rng = small_model(500)
    z = np.repeat(rng.standard_normal((1, attention_lm.WIDTH)).astype(np.float32), 500, axis=0)
    assert math.isclose(np.exp(attention_lm.log_classes(w, z, classes.of) + classes.log_share).sum(), 1, abs_tol=1e-4)


def test_gradients_equal_differences():
    classes, w, rng = small_model()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rows = rng.integers(0, 40, (3, attention_lm.WINDOW))
    there = np.ones(rows.shape, bool)
    there[0, : attention_lm.BEFORE] = there[1, -5:] = False
    targets, new = rng.integers(0, classes.n, (3, attention_lm.FRESH)), there[:, attention_lm.BEFORE :]

    def loss():
        z = attention_lm.attended(w, rows, there)["z"]
        return -attention_lm.log_classes(w, z[new], targets[new]).mean()

    g = attention_lm.gradients(w, rows, there, targets)
    assert set(g) == set(w)
    for name, weight in w.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), weight.shape)
        before = weight[at]
        weight[at] = before + 1e-5
        up = loss()
        weight[at] = before - 1e-5
        down = loss()
        weight[at] = before
        assert math.isclose(g[name][at], (up - down) / 2e-5, rel_tol=1e-3), name


def test_classes_far_apart_keep_finite_sums_and_gradients():
    classes, w, rng = small_model()
    w["out_bias"] = np.linspace(-400, 400, classes.n).astype(np.float32)
    z, targets = rng.standard_normal((30, attention_lm.WIDTH)).astype(np.float32), rng.integers(0, classes.n, 30)
    logits = z.astype(float) @ w["out"] + w["out_bias"]
    want = logits[np.arange(30), targets] - logits.max(axis=1) - np.log(np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1))
    found = attention_lm.logits_of(w, z)
    total, top = attention_lm.powers(w, z, found)
    assert np.isfinite(total).all() and top is not None and np.allclose(attention_lm.log_classes(w, z, targets), want, atol=1e-3)
    rows = rng.integers(0, 40, (2, attention_lm.WINDOW))
    g = attention_lm.gradients(w, rows, np.ones(rows.shape, bool), rng.integers(0, classes.n, (2, attention_lm.FRESH)))
    assert all(np.isfinite(v).all() for v in g.values())


def test_model_tells_words_apart_without_word_ids():
    """Words go to the tokenizer's model by the call that leaves out their numbers, with the same ids and sizes."""
    known = packing_ga.WordIds(TOKENIZER)
    words = ["the", "thonheha", "a", "was", "xqzjvk", "the"] * 50
    found = known.model.encode(words, is_pretokenized=True, add_special_tokens=False)
    want = (np.bincount(found.word_ids).tolist(), found.ids)
    model, slow = known.model, []

    class Model:
        encode_batch_fast = model.encode_batch_fast

        def encode(self, *args, **kwargs):
            slow.append(args)
            return model.encode(*args, **kwargs)

    known.model = Model()
    assert tuple(x.tolist() for x in known.modelled(words)) == want and not slow
    # Where tokens do not tell, the numbers are asked for.
    known.last[:] = False
    assert tuple(x.tolist() for x in known.modelled(words)) == want and slow


def test_every_subword_of_training_has_weights_of_its_own():
    """A subword of a band follows its neighbour, not its share of the counts; only those that are never met share."""
    counts = np.array([900.0] * 28 + [5.0] * 60 + [0.0] * 12)
    classes = attention_lm.Classes(counts, np.arange(100) % 2 == 0)
    members = classes.member[28:88]
    assert sorted(members.tolist()) == list(range(1, 61)) and not classes.member[:28].any() and not classes.member[88:].any()
    assert len(set(classes.row.tolist())) == 100 and len(set(classes.of[:28].tolist())) == 28 and len(set(classes.of[88:].tolist())) == 1
    w, rng = attention_lm.first_weights(classes), np.random.default_rng(1)
    z = rng.standard_normal((60, attention_lm.WIDTH)).astype(np.float32)
    assert np.allclose(attention_lm.log_members(w["own"], z, members, classes.bounds), classes.log_share[28:88], atol=1e-5)
    w["own"] = rng.standard_normal(w["own"].shape).astype(np.float32)
    for state in z[:5]:
        logs = attention_lm.log_classes(w, np.tile(state, (100, 1)), classes.of)
        inside = attention_lm.log_members(w["own"], np.tile(state, (100, 1)), classes.member, classes.bounds)
        assert math.isclose(np.exp(logs + np.where(classes.member > 0, inside, classes.log_share)).sum(), 1, abs_tol=1e-4)
        assert not np.allclose(inside[28:88], classes.log_share[28:88], atol=0.1)


def test_gradients_inside_bands_equal_differences():
    classes, w, rng = small_model(60)
    w = {k: v.astype(np.float64) for k, v in w.items()}
    w["own"] += rng.standard_normal(w["own"].shape) * 0.3
    rows = rng.integers(0, 60, (3, attention_lm.WINDOW))
    there = np.ones(rows.shape, bool)
    there[0, : attention_lm.BEFORE] = there[1, -5:] = False
    subs = rng.integers(0, 60, (3, attention_lm.FRESH))
    new = there[:, attention_lm.BEFORE :]
    targets, members = classes.of[subs], np.where(new, classes.member[subs], 0)

    def loss():
        z = attention_lm.attended(w, rows, there)["z"][new]
        logs = attention_lm.log_classes(w, z, targets[new]) + attention_lm.log_members(w["own"], z, members[new], classes.bounds)
        return -logs.mean()

    g = attention_lm.gradients(w, rows, there, targets, members, classes.bounds)
    for name, weight in w.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), weight.shape)
        before = weight[at]
        weight[at] = before + 1e-5
        up = loss()
        weight[at] = before - 1e-5
        down = loss()
        weight[at] = before
        assert g[name][at] and math.isclose(g[name][at], (up - down) / 2e-5, rel_tol=1e-3), name


def test_model_learns_which_subword_of_a_band_follows(spark, monkeypatch):
    """Pairs of rare words always follow one another; tasks average what they have learnt of them."""
    pairs = ["the was", "was the", "to of", "of to", "and in", "in and", "he she", "she he"]
    rng = random.Random(3)
    rows = [(k, "en", " ".join(rng.choice(pairs) for _ in range(600))) for k in range(400)]
    monkeypatch.setattr(attention_lm, "OWN_CLASSES", 1)
    monkeypatch.setattr(attention_lm, "BANDS", 1)

    def mean():
        found = attention_lm.scored(table_of(spark, rows).repartition(2), TOKENIZER).filter("held_out").collect()
        return sum(r["score"] for r in found) / sum(r["n_tokens"] for r in found)

    # A word's share of its band is an eighth: -0.9. Its neighbour tells more, up to -0.45.
    after = mean()
    monkeypatch.setattr(attention_lm, "ROUNDS", 0)
    assert mean() < -0.8 and after > -0.7


def test_no_place_sees_a_later_one_and_each_is_scored_once():
    classes, w, rng = small_model()
    rows = rng.integers(0, 40, (2, attention_lm.WINDOW))
    there = np.ones(rows.shape, bool)
    other = rows.copy()
    other[:, 20:] = 7
    a, b = attention_lm.attended(w, rows, there)["z"], attention_lm.attended(w, other, there)["z"]
    cut = 20 - attention_lm.BEFORE
    assert np.allclose(a[:, :cut], b[:, :cut], atol=1e-6) and not np.allclose(a[:, cut:], b[:, cut:])
    sizes = np.array([1, 23, 24, 25, 48, 57, 200])
    windows = attention_lm.Windows(sizes)
    place, there = windows.places(np.arange(len(windows.doc)))
    assert sorted(place[:, attention_lm.BEFORE :][there[:, attention_lm.BEFORE :]].tolist()) == list(range(sizes.sum()))
    assert np.bincount(windows.doc).tolist() == windows.number.tolist()


def test_rounds_take_every_window_of_training_documents_once():
    sizes = np.array([1, 16, 17, 40, 500, 3000, 90])
    windows, trains = attention_lm.Windows(sizes), np.array([True, True, False, True, True, True, False])
    rounds = [attention_lm.taken(windows, trains, number) for number in range(attention_lm.ROUNDS)]
    assert sorted(np.concatenate(rounds).tolist()) == np.flatnonzero(trains[windows.doc]).tolist()


def test_windows_laid_out_hold_the_values_of_their_places():
    sizes = np.array([1, 16, 17, 40, 500])
    flat = np.arange(1, sizes.sum() + 1)
    windows = attention_lm.Windows(sizes)
    place, there = windows.places(np.arange(len(windows.doc)))
    at, values, here = windows.laid_out(flat, np.ones(len(flat), bool))
    assert (here[at] == there).all() and (values[at] == np.where(there, flat[place], 0)).all()


def test_scores_do_not_depend_on_blocks_and_slices(spark, monkeypatch):
    docs = table_of(spark, [(k, "en", t) for k, t in enumerate(texts() + [prose(50 + k, 90) for k in range(60)])]).coalesce(1)
    columns = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    monkeypatch.setattr(attention_lm, "ROUNDS", 0)

    def scores():
        return sorted((*r[:5], round(r[5], 6), round(r[6], 2)) for r in attention_lm.scored(docs, TOKENIZER).select(columns).collect())

    whole = scores()
    monkeypatch.setattr(attention_lm, "SLICE_BYTES", 700)
    monkeypatch.setattr(attention_lm, "BLOCK_BYTES", 4000)
    cut = scores()
    assert [r[:6] for r in cut] == [r[:6] for r in whole]
    assert all(math.isclose(a[6], b[6], rel_tol=1e-4) for a, b in zip(cut, whole))


def test_words_go_to_the_join_once_for_several_slices(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "SLICE_BYTES", 700)
    run = attention_lm.block_rows(TOKENIZER, 10)
    docs = table_of(spark, [(k, "en", prose(50, 90)) for k in range(60)]).coalesce(1)
    rows = docs.select(F.col("id"), F.col("text")).mapInArrow(run, attention_lm.BLOCK).select("ids", "words").collect()
    assert [len(r["ids"]) for r in rows] == [60] and len(rows[0]["words"]) == len(set(prose(50, 90).split()))


def test_words_of_all_blocks_meet_in_few_rows(spark, tmp_path, monkeypatch):
    """Counts are exact, and a block sends each bucket one row, not one for each word."""
    monkeypatch.setattr(attention_lm, "SLICE_BYTES", 700)
    monkeypatch.setattr(attention_lm, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(attention_lm, "BUCKET_WORDS", 300)
    rows = [(k, prose(50 + k, 90)) for k in range(40)] + [(10**12, "été " * 3), (None, "only held out"), (3, None)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    blocks = attention_lm.stored(docs.mapInArrow(attention_lm.block_rows(TOKENIZER, 10), attention_lm.BLOCK), f"{tmp_path}/blocks")
    found = attention_lm.word_counts(blocks).toArrow()
    counts = Counter(w for i, t in rows if attention_lm.learnt_from(i, 10) for w in lower(t or "").split())
    held = blocks.select("block", "words").collect()
    buckets = -(-sum(len(r["words"]) for r in held) // 300)
    assert len(held) > 2 and buckets > 1 and found.num_rows <= len(held) * buckets
    got = {r["block"]: {} for r in held}
    for k, block in enumerate(found["block"].to_pylist()):
        places, c = attention_lm.ints(found, "places", k), attention_lm.ints(found, "c", k, "<i8")
        got[block] |= dict(zip(places.tolist(), c.tolist(), strict=True))
    for r in held:
        words = [bytes(w).decode() for w in r["words"]]
        assert got[r["block"]] == {k: counts[w] for k, w in enumerate(words) if counts[w]}
    assert (sum(found["total"].to_pylist()), sum(found["distinct"].to_pylist())) == (counts.total(), len(counts))


def test_scores_of_empty_texts_only(spark):
    rows = attention_lm.scored(table_of(spark, [(1, "en", None), (2, "en", ""), (3, "en", " ")]), TOKENIZER).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows) == [(1, 1, 3)] * 3


def test_score_is_that_of_plain_attention_place_by_place():
    classes, w, rng = small_model()
    sizes = np.array([1, 50, 77])
    flat = rng.integers(0, 40, sizes.sum())
    got = attention_lm.log_probabilities(w, classes, sizes, flat, 0)
    half = attention_lm.WIDTH // attention_lm.HEADS
    for doc, stop in enumerate(np.cumsum(sizes)):
        own = flat[stop - sizes[doc] : stop]
        seen, total = np.concatenate(([0], own[:-1])), 0.0
        for at in range(len(own)):
            begin = at // attention_lm.FRESH * attention_lm.FRESH - attention_lm.BEFORE
            keys = np.arange(max(0, begin), at + 1)
            x = w["token"][classes.row[seen[keys]]] + w["place"][keys - begin]
            heads = []
            for h in range(attention_lm.HEADS):
                part = slice(h * half, (h + 1) * half)
                score = (x @ w["key"][:, part]) @ (x[-1] @ w["query"][:, part]) / math.sqrt(half)
                weight = np.exp(score) / np.exp(score).sum()
                heads.append(weight @ (x @ w["value"][:, part]))
            y = x[-1] + np.concatenate(heads) @ w["joined"]
            z = y + np.maximum(y @ w["up"] + w["up_bias"], 0) @ w["down"]
            logits = z @ w["out"] + w["out_bias"]
            total += logits[classes.of[own[at]]] - np.log(np.exp(logits).sum()) + classes.log_share[own[at]]
        assert math.isclose(got[doc], total / math.log(10), rel_tol=1e-4)


def test_training_helps_on_held_out_documents(spark, sf_dir, monkeypatch):
    docs = queries.table(spark, sf_dir, "documents")

    def mean():
        rows = attention_lm.scored(docs, TOKENIZER).filter("held_out").collect()
        return sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows)

    after = mean()
    monkeypatch.setattr(attention_lm, "ROUNDS", 0)
    assert after > mean() + 0.2


@pytest.mark.parametrize("name", ["op11_phrase_rollup", "op12_radix_audit"])
def test_registered_query_matches_brute_force(spark, sf_dir, name):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "lang", "text").collect()]
    labels = [tuple(r) for r in queries.table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").collect()]
    want = phrases_by_hand(rows) if name.startswith("op11") else audit_by_hand(rows, labels)
    assert sorted(map(tuple, entry.queries()[name](spark, sf_dir).collect())) == want
    assert name in entry.oracle_sql()
