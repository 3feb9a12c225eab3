"""Each operator against brute force, an exact round trip or held-out accuracy, and its edge cases."""

import datetime
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import iblt, jaccard, langid, mil, mixing, pfor, queries, rules, simhash, spbpe, surrogates, zdict

SF = "/root/testdata/sf0.001"
LONG = "word " * 20_000 + "x" * 50_000
#: Nulls, empty and very long texts, white space, ties and repeated rows.
EDGE = [(1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (None, "same text here. And more of it.", "b"), (5, "same text here. And more of it.", "b"), (5, "same text here. And more of it.", "b"), (7, LONG, None), (8, "!!! 123 ---", "c"), (9, "a  b\n\n\nc \n d", "c"), (10, "é的😀 <|endoftext|> ▁x", "c")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, s, "en", "s", 1.5, "f") for i, t, s in EDGE]
    # columns whose names clash with what operators add
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score string, fp double, fingerprint string").cache()


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# -- 1 -----------------------------------------------------------------------------------------------------------

UNITS = re.compile(rf"(?:[^ \t\n\x0b\f\r]{{1,{iblt.PIECE_CHARS}}}+[ \t\x0b\f\r]*+){{1,{iblt.PIECE_WORDS}}}+")


def likeness(a, b):
    a, b = set(UNITS.findall(a)), set(UNITS.findall(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def edits(rows):
    """Brute force of op1 over (doc_id, text) without repeated ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    for i, (d, t) in enumerate(rows):
        t, n = t or "", rows[(i + 1) % len(rows)][1] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        yield d, (len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(t, e), likeness(t, n))


def test_op1_equals_brute_force(spark, docs):
    got = by_id(iblt.compare_edits(docs))
    want = dict(edits([(r.doc_id, r.text) for r in docs.collect()]))
    assert got.keys() == want.keys()
    for d, (n, sha, near, far) in want.items():
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, sha) and abs(r.near_edited - near) < 1e-12 and abs(r.near_next - far) < 1e-12
    texts = {}
    for r in docs.collect():
        assert texts.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint


def test_op1_edges(spark, edge, empty):
    assert iblt.compare_edits(empty).count() == 0
    got = iblt.compare_edits(edge).collect()
    assert len(got) == len(EDGE) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = spark.createDataFrame([(4, "a b c")], "doc_id long, text string")
    assert iblt.compare_edits(one).first().near_next == 1.0
    gaps = spark.createDataFrame([(i * i * 10**9, f"text {i}") for i in range(300)], "doc_id long, text string")
    got = by_id(iblt.compare_edits(gaps))
    for d, (n, sha, *_) in edits([(r.doc_id, r.text) for r in gaps.collect()]):
        assert got[d].edited_sha256 == sha


def test_op1_peeling_recovers_the_difference(spark):
    rng = random.Random(3)
    rows = []
    for k in range(120):
        common, a, b = (rng.sample(range(k * 10**6, k * 10**6 + 10**6), n) for n in (rng.randrange(40), rng.randrange(60), rng.randrange(60)))
        rows.append((k, common + a, common + b))
    df = spark.createDataFrame(rows, "k int, a array<bigint>, b array<bigint>")
    df = df.select("k", "a", "b", F.struct(F.col("a").alias("d"), iblt.sketch(F.col("a")).alias("s")).alias("x"), F.struct(F.col("b").alias("d"), iblt.sketch(F.col("b")).alias("s")).alias("y"))
    for r in iblt.with_differences(df, "x", ["y"], "z").select("a", "b", "z").collect():
        assert set(r.z[0].r.a) == set(r.a) - set(r.b) and set(r.z[0].r.b) == set(r.b) - set(r.a)


# -- 2 -----------------------------------------------------------------------------------------------------------


def mixture(tokens, entropy, repetition):
    """Weights by a plain scan of exponents (least budget that keeps all)."""
    total = sum(tokens.values())
    p = {k: n / total for k, n in tokens.items()}

    def at(a):
        z = sum(x**a for x in p.values())
        w = {k: x**a / z for k, x in p.items()}
        gain = [w[k] / p[k] for k in p]
        return w, -sum(x * math.log(x) for x in w.values()), max(gain) / min(gain)

    fits = [k / 20_000 for k in range(20_001) if at(k / 20_000)[1] >= entropy * math.log(len(p))]
    limit = [k / 20_000 for k in range(20_001) if at(k / 20_000)[2] <= repetition]
    return at(max(max(fits), min(limit)))[0]


@pytest.mark.parametrize("entropy,repetition", [(0.95, 10.0), (0.99, 1.5)])
def test_op2_weights_and_budgets(spark, entropy, repetition):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), "abcd"[min(3, int(rng.expovariate(1)))]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, entropy, repetition).toPandas()
    tokens = df.toPandas().assign(n=lambda d: d.text.str.split().str.len()).groupby("source").n.sum().to_dict()
    want = mixture(tokens, entropy, repetition)
    weight = got.groupby("source").weight.first()
    for k, w in want.items():
        assert abs(weight[k] - w) < 1e-3
    taken = got.groupby("source").n_tokens.sum()
    budget = max(tokens[k] / weight[k] for k in tokens)
    for k in tokens:
        assert 0 <= taken[k] - round(weight[k] * budget) < 30
        assert taken[k] / tokens[k] <= repetition * 1.02
    assert set(got.doc_id) == set(range(4000))
    assert not got.duplicated(["doc_id", "epoch"]).any()
    block = got.groupby(["source", "epoch", "block"]).position.nunique()
    assert (block == 1).all()


def test_op2_given_budget_takes_less(spark, docs):
    got = mixing.mix(docs, 0.9, 4.0, budget=20_000).toPandas()
    assert 20_000 <= got.n_tokens.sum() < 20_000 + 6_000 * got.source.nunique()


def test_op2_edges(edge, empty):
    assert mixing.mix(empty).count() == 0
    got = mixing.mix(edge, 0.5, 1.0).collect()
    assert len(got) == len(EDGE) and {r.source for r in got} == {None, "a", "b", "c"}


# -- 3, 6, 7: held-out accuracy ----------------------------------------------------------------------------------


def held(spark, name):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, sf).filter("held_out")
    return got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas(), got, sf


def test_op3_held_out(spark):
    d, got, _ = held(spark, "op3_compression")
    assert (d.predicted == d.quality).mean() > 0.97 and d.score.between(0, 1).all()
    assert ((d.score >= 0.3) == (d.predicted == 1)).all()


def test_op6_held_out(spark):
    d, got, _ = held(spark, "op6_toxicity")
    assert ((d.predicted == 1) & (d.toxic == 0)).sum() <= 0.01 * (d.toxic == 0).sum()
    assert d[d.toxic == 1].predicted.mean() > 0.6  # a few hundred toxic rows teach most of the words


def test_op6_locates_sentences(spark):
    rows = [(f"A fine day. {'You awful grumbler!' if i % 3 == 0 else 'The sun is up.'} All is well {i}.", int(i % 3 == 0)) for i in range(300)]
    model = mil.fit(rows)
    text = "The sun is up. You awful grumbler! All is well."
    assert [text[a:b] for a, b, _ in model.offending(text)] == [" You awful grumbler!"]
    assert model.score(text) > 0.7 > 0.3 > model.score("The sun is up. All is well.")
    assert model.score("The sun is up. " * 3000) < 0.5


def test_op7_held_out(spark):
    sf = "/root/testdata/sf0.1"
    d = queries.op7_language(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (d.lang == d.lang_pred).mean() > 0.99 and d.score.between(0, 1).all()


def test_classifiers_edges(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for model in (zdict.fit_on(edge, labels, F.lit(True)), zdict.fit([("a b c", 1), ("!!!", 0)])):
        assert zdict.predict(empty, model).count() == 0
        got = zdict.predict(edge, model).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    for model in (mil.fit_on(edge, labels, F.lit(True)), mil.fit([("a b c", 0), ("bad one", 1)])):
        assert mil.predict(empty, model).count() == 0
        got = mil.predict(edge, model, spans=True).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    for model in (langid.fit_on(edge, F.lit(True)), langid.fit_on(empty, F.lit(True))):
        assert langid.predict(empty, model).count() == 0
        got = langid.predict(edge, model).collect()
        assert len(got) == len(EDGE)
        for r in got:
            letter = {i: t for i, t, _ in EDGE}[r.doc_id]
            assert 0 <= r.score <= 1 and (r.lang_pred != "und" or not model.labels or not any(c.isalpha() for c in letter or ""))
        assert all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3, 8))


def test_op7_training_equals_a_plain_version():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        at = np.sort(rng.choice(12, 4, replace=False))
        rows.append(((at, rng.random(4) * np.where(at == 11, 1e-3, 1.0)), int(at[0] % 3)))
    weights, bias = langid.ftrl(rows, 12, 3)
    # one weight at a time, from the definition of the proximal step
    z, n = {}, {}
    at = lambda d, k: d.get(k, 0.0)

    def weight(k):
        if abs(at(z, k)) <= langid.L1:
            return 0.0
        return -(at(z, k) - math.copysign(langid.L1, at(z, k))) / ((langid.BETA + math.sqrt(at(n, k))) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for (idx, x), y in rows:
            pairs = [(int(i), float(v)) for i, v in zip(idx, x)] + [(12, 1.0)]
            scores = [sum(v * weight((i, c)) for i, v in pairs) for c in range(3)]
            e = [math.exp(s - max(scores)) for s in scores]
            step = {}
            for c in range(3):
                miss = e[c] / sum(e) - (c == y)
                for i, v in pairs:
                    g, k = v * miss, (i, c)
                    sigma = (math.sqrt(at(n, k) + g * g) - math.sqrt(at(n, k))) / langid.ALPHA
                    step[k] = g - sigma * weight(k), g * g
            for k, (dz, dn) in step.items():
                z[k], n[k] = at(z, k) + dz, at(n, k) + dn
    for i in range(13):
        for c in range(3):
            assert abs((weights[i][c] if i < 12 else bias[c]) - weight((i, c))) < 1e-9
    assert any(weight((i, c)) == 0 for i in range(12) for c in range(3))


def test_op6_step_follows_the_gradient_of_the_noisy_or():
    model = mil.Model({"bad": 7.0, "worse": 9.0, "mild": 2.0}, mil.BIAS)
    text = "A bad thing. The mild sun!\nWorse and bad. Nothing here"
    sentence = lambda s: 1 / (1 + math.exp(-(mil.BIAS + sum({"bad": 7.0, "worse": 9.0, "mild": 2.0}.get(w, 0) for w in set(s.lower().split())))))
    p = [sentence("a bad thing"), sentence("the mild sun"), sentence("worse and bad"), sentence("nothing here")]
    clear = [x for x in p if math.log(x / (1 - x)) >= mil.CLEAR]
    faint = max(x for x in p if x not in clear)
    none = math.prod(1 - x for x in clear) * (1 - faint)
    assert abs(model.clean(text) - math.log(none)) < 1e-9
    # the gradient that fit() climbs, against differences of the likelihood
    words = [["bad"], ["mild"], ["bad", "worse"]]

    def likelihood(w, y):
        p = [1 / (1 + math.exp(-(mil.BIAS + sum(w[x] for x in s)))) for s in words]
        any_ = 1 - math.prod(1 - x for x in p)
        return math.log(any_) if y else math.log(1 - any_)

    w = {"bad": 4.0, "worse": 5.0, "mild": 1.0}
    for y in (0, 1):
        p = [1 / (1 + math.exp(-(mil.BIAS + sum(w[x] for x in s)))) for s in words]
        none = math.prod(1 - x for x in p)
        pull = none / (1 - none) if y else -1.0
        for k in w:
            near = (likelihood({**w, k: w[k] + 1e-6}, y) - likelihood({**w, k: w[k] - 1e-6}, y)) / 2e-6
            assert abs(near - sum(pull * q for q, s in zip(p, words) if k in s)) < 1e-6


def test_op3_sizes_equal_plain_compression():
    import zstandard

    rng = random.Random(4)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(200)) for _ in range(60)]
    bad = [" ".join(rng.choice(["click", "win", "now", "free$$"]) for _ in range(200)) for _ in range(60)]
    model = zdict.fit([(t, 1) for t in good] + [(t, 0) for t in bad])
    for text in (good[0], bad[0], "é" * 5000, "x"):
        raw = text.encode()
        parts = [raw[k : k + zdict.WINDOW] for k in range(0, len(raw), zdict.WINDOW)]
        size = {}
        for name, d in (("good", model.good), ("bad", model.bad)):
            make = zstandard.ZstdCompressor(level=zdict.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False)
            size[name] = sum(len(make.compress(x)) for x in parts)
        n, g, b, _ = model.sizes(text)
        assert (n, g, b) == (len(raw), size["good"], size["bad"])
        assert abs(model.inputs(text)[0] - (size["bad"] - size["good"]) / (len(raw) + 8)) < 1e-12
    assert min(model.score(t) for t in good) > 0.5 > max(model.score(t) for t in bad)
    assert model.inputs("") == (0.0, 0.0)


def test_op7_large_scripts_are_told_apart():
    rng = random.Random(2)
    word = lambda low, high: "".join(chr(rng.randrange(low, high)) for _ in range(3))
    kinds = {"zh": (0x4E00, 0x9FA0), "ko": (0xAC00, 0xD7A0), "en": (0x61, 0x7B)}
    rows = [(" ".join(word(*r) for _ in range(20)), y) for y, r in kinds.items() for _ in range(60)]
    rng.shuffle(rows)
    model = langid.fit(rows)  # most letters are beyond the alphabet
    assert all(model.predict(" ".join(word(*r) for _ in range(20)))[0] == y for y, r in kinds.items() for _ in range(20))


def test_pipeline_language_bound_is_above_chance(spark):
    labels = [f"l{k}" for k in range(4)]
    model = langid.Model(labels, "ab", np.array([1]), np.ones(1), np.array([[0.0, 0.0, 0.0, math.log(2.0)]]), np.zeros(4))
    df = spark.createDataFrame([(1, "a"), (2, "!")], "doc_id long, text string")  # the likeliest has 0.4, 0.2 above chance
    assert [r.doc_id for r in langid.keep(df, model, 0.19).collect()] == [1] and langid.keep(df, model, 0.21).count() == 0


def test_op9_is_linear_on_unbroken_runs():
    import time

    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    codec, own = spbpe.codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(1)
    took = []
    for n in (50_000, 400_000):
        text = "".join(rng.choice("etaoinshrdlu") for _ in range(n))
        start = time.process_time()
        ids, _ = codec.encode(text)
        took.append(time.process_time() - start)
    assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_bos=True, add_eos=True)
    assert took[1] < 24 * took[0] + 1


# -- 4 -----------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.sampled_from([0.5, 0.9, 1.0]))
def test_op4_blocks_round_trip(ids, percentile):
    a = np.array(ids, np.uint32)
    blocks = pfor.encode_blocks(a, percentile)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    assert (pfor.decode_blocks(b"".join(blocks), starts) == a).all()


def test_op4_equals_the_library(spark, edge, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rng = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "的", "1", "23", "!", "...", "'s", "\x85", "\xa0", "　", "\x1c", "\r\n", "<|endoftext|>", "Ġ", "Word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)]
    words = ["Word", "end", "é", "ñu", "的", "x1", "9", "it's", "-", "!", "..", "a#", "ß", "Ǆ", "\x01", "don't,"]
    texts += [" ".join(rng.choice(words) + rng.choice(["", "", ".", "!", "?", ",", "...", "!!", ".\n"]) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    ids, lengths = pfor.Encoder(path).batch(texts, 7)
    assert len(lengths) == len(texts) and lengths.sum() == len(ids)
    for t, got in zip(texts, np.split(ids, np.cumsum(lengths)[:-1])):
        assert got.tolist() == own.encode(t, add_special_tokens=False).ids + [7], t
    assert pfor.round_trip(empty, path).count() == 0
    for df in (edge, docs):
        rows = sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        start, want = 0, []
        for d, t in rows:
            ids = own.encode(t or "", add_special_tokens=False).ids + [0]
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = [tuple(r) for r in pfor.round_trip(df, path).orderBy("start").collect()]
        assert got == want


def test_op4_index_reaches_any_range(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_000, 10_000, dtype=np.uint32)
    path = str(tmp_path / "x.pfr")
    out = pfor.Writer(path)
    out.add(pa.array([1, None], pa.int64()), np.array([6_000, 4_000]), ids)
    out.close()
    shard = pfor.Shard(path)
    for a, b in ((0, 0), (5, 9), (1000, 1030), (9_990, 10_000), (0, 10_000)):
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert [(d, s, len(x)) for d, s, x in shard.documents()] == [(1, 0, 6_000), (None, 6_000, 4_000)]


# -- 5 -----------------------------------------------------------------------------------------------------------


def luhn(d):
    return sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(d))) % 10


def test_op5_formats_and_coreference(spark):
    text = "Mail und.34@mail7.example.com, call +1 (017) 555-7713 or 233.254.104.120; card 4111 1111 1111 1111 and 4111111111111111. Mr. John Smith met Mrs. Anna Smith and Mr. Smith. Господин Иван Петров. SSN 123-45-6789, key 04dbebab91ab85687d33eeaaf9ac699e1188f962. Mail und.34@mail7.example.com again, v1.2, 3.14 and 12."
    new = surrogates.replace(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first().text
    for gone in ("und.34", "017", "555-7713", "233.254", "4111", "John", "Smith", "Anna", "Петров", "123-45", "04dbebab"):
        assert gone not in new
    mails = re.findall(r"[a-z]{3}\.\d\d@[a-z]+\.example\.com", new)
    assert len(mails) == 2 and len(set(mails)) == 1
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} or (\d{1,3}\.){3}\d{1,3}; card", new)
    spaced, plain = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16})\.", new).groups()
    assert spaced.replace(" ", "") == plain and luhn(plain) == 0
    him, her, short = re.search(r"Mr\. \w+ (\w+) met Mrs\. \w+ (\w+) and Mr\. (\w+)\.", new).groups()
    assert him == her == short and re.search(r"Господин [А-Яа-я]+ [А-Яа-я]+\.", new)
    assert re.search(r"SSN \d{3}-\d\d-\d{4}, key [0-9a-f]{40}\.", new) and new.endswith("again, v1.2, 3.14 and 12.")


def test_op5_keeps_entities_distinct(spark):
    rows = [(i, f"{chr(97 + i % 26)}@b.co {i // 26 % 256}.0.0.{i % 26} {10**15 + i} Mr. Abc{'abcdefghij'[i % 10]}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    new, seen = by_id(surrogates.replace(df, "k")), {}
    for i, t in rows:
        a, b = t.split(" ", 3), new[i].text.split(" ", 3)
        for x, y in zip(a, b):
            assert seen.setdefault(x, y) == y and x != y
    assert len(set(seen.values())) == len(seen)
    other = by_id(surrogates.replace(df, "another key"))
    assert sum(other[i].text == new[i].text for i, _ in rows) == 0


def test_op5_digit_permutation_is_one_to_one_and_moves_all(spark):
    got = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select("d", surrogates.digits(F.col("d"), "k", F.lit("s")).alias("n")).collect()
    assert sorted(r.n for r in got) == [f"{i:03}" for i in range(1000)] and all(r.d != r.n for r in got)


def test_op5_dates_are_one_to_one(spark):
    days = [datetime.date(1960, 1, 1) + datetime.timedelta(k) for k in range(0, 3000)]
    rows = [(f"{d:%Y-%m-%d}",) for d in days] + [(f"{d:%d.%m.%Y}",) for d in days[:500]]
    got = spark.createDataFrame(rows, "d string").select("d", surrogates.born(F.col("d"), "k", F.lit("0")).alias("n")).collect()
    assert len({r.n for r in got}) == len(rows) and all(r.d != r.n for r in got)
    for r in got:
        datetime.datetime.strptime(r.n, "%Y-%m-%d" if "-" in r.d else "%d.%m.%Y")


def test_op5_ibans_keep_their_checks(spark):
    def valid(t):
        t = t.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1

    good = ["GB29 NWBK 6016 1331 9268 19", "GB29NWBK60161331926819", "DE89370400440532013000", "FR1420041010050500013M02606", "ES9121000418450200051332"]
    rows = [(k, f"To {x}, please.") for k, x in enumerate(good + ["DE88370400440532013000"])]
    got = [t[3:-9] for t in (r.text for r in surrogates.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").orderBy("doc_id").collect())]
    assert [valid(x) for x in got] == [True] * 5 + [False] and got[0].replace(" ", "") == got[1]
    assert all(x[:2] == y[:2] and len(x) == len(y) and x != y for x, y in zip(got, good)) and len(set(got)) == 6


#: Sentences by the entities in them; none of these may stay, and the sentences of the second list must.
PRIVATE = [
    ("Mr. John Smith called.", "John Smith"), ("Dr. Maria Garcia wrote.", "Maria Garcia"), ("Yesterday Ana Lopez left.", "Ana Lopez"),
    ("Prof Иванов пришёл.", "Иванов"), ("Sra. Carmen Ruiz y Pilar Gómez.", "Carmen Ruiz Pilar Gómez"), ("王伟先生来了。", "王伟"), ("Mr. 李娜 spoke.", "李娜"),
    ("Reach 2001:db8:85a3::8a2e:370:7334 now.", "2001:db8:85a3::8a2e:370:7334"), ("Ring 020 7946 0958 today.", "7946 0958"), ("Ring +49 30 901820 today.", "901820"),
    ("She was born on 1980-03-07.", "1980-03-07"), ("DOB: 24/12/1975.", "24/12/1975"), ("Passport no. X1234567 is lost.", "1234567"),
    ("He lives at 221 Baker Street.", "221 Baker"), ("Host 10.20.30.40 is up.", "10.20.30.40"), ("SSN 123-45-6789.", "123-45-6789"),
    ("Card 4111 1111 1111 1111.", "4111"), ("Write to ana.l@example.org.", "ana.l @example.org"), ("IBAN DE89370400440532013000.", "0532013000"),
]
HARMLESS = ["The court met on Main Hill.", "std::vector and a::b are types.", "On 2020-01-02 we shipped 1.2.3.", "Call it 12 or 3.14 or 1,000,000.", "John came.", "Chapter 12 Street life.", "At 10:30:45 it rang.", "Isbn 978 and no. 123456."]


def test_op5_recall_and_precision(spark):
    rows = [(k, t) for k, t in enumerate([t for t, _ in PRIVATE] + HARMLESS)]
    got = by_id(surrogates.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k"))
    for k, (_, gone) in enumerate(PRIVATE):
        for word in gone.split(" "):
            assert word not in got[k].text, (word, got[k].text)
    assert [got[len(PRIVATE) + k].text for k in range(len(HARMLESS))] == HARMLESS


def test_op5_names_agree_after_collisions(spark):
    family = [f"Na{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"] * 4
    family = [f + x for f, x in zip(family, [""] * 150 + ["ka"] * 150 + ["vo"] * 150 + ["ti"] * 150)]
    rows = [(k, f"Mr. {f} came. Mr. John {f} spoke, and {f} left.") for k, f in enumerate(family)]
    text = spark.createDataFrame(rows, "doc_id long, text string")
    words = [re.findall(r"^Mr\. (\S+) came\. Mr\. (\S+) (\S+) spoke, and (\S+) left\.$", r.text)[0] for r in surrogates.replace(text, "k").orderBy("doc_id").collect()]
    assert all(a == c == d for a, _, c, d in words) and len({a for a, *_ in words}) == len(family) and len({b for _, b, *_ in words}) == 1
    assert any("-" in a for a, *_ in words)  # some collided


def test_op5_many_collisions_join_only_texts_with_entities(spark, monkeypatch):
    family = [f"Na{a}{b}{c}{d}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst" for d in ("", "ka", "vo", "ti")]
    rows = [(k, f"Mr. {f} came.") for k, f in enumerate(family)] + [(None, None), (None, ""), (-1, "none here"), (5, rows_text := "Mr. Nabal came."), (5, rows_text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, surrogates.replace(df, "k").collect()))
    monkeypatch.setattr(surrogates, "MOST_LISTED", 0)
    assert sorted(map(str, surrogates.replace(df, "k").collect())) == want


def test_op5_raises_where_collisions_remain(spark):
    found = spark.createDataFrame([(f"n\x1fName{k}",) for k in range(3000)], "entity string")
    with pytest.raises(ValueError):
        surrogates.collisions(found, "k", most_rounds=1)


def test_op5_edges(edge, empty):
    assert surrogates.replace(empty, "k").count() == 0
    got = surrogates.replace(edge, "k")
    assert got.columns == edge.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, edge.collect()))


# -- 8 -----------------------------------------------------------------------------------------------------------


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeat = {i + k for xs in at.values() if len(xs) > 1 for i in xs for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat)


def test_op8_equals_brute_force(spark, edge, empty, docs):
    rng = random.Random(2)
    made = spark.createDataFrame([(i, "".join(rng.choice(["a", "b", " ", "\n", "#", "é", "\x0b", "\xa0", "😀"]) for _ in range(rng.randrange(80)))) for i in range(400)], "doc_id long, text string")
    assert rules.judge(empty).count() == 0
    for df in (made, docs):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in rules.judge(df).collect():
            n, *rest = want = measured(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (n < 50 or 100 * rest[3] > 50 * n) and not (r.base_failed and r.kept)
    assert rules.judge(edge).count() == len(EDGE)


# -- 9 -----------------------------------------------------------------------------------------------------------


def test_op9_equals_the_library(spark, edge, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own, lib = spbpe.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)

    def same(t):
        ids = lib.encode(t, add_bos=True, add_eos=True)
        got, decoded = own.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == ids and decoded.decode() == lib.decode(ids), t

    rng = random.Random(3)
    parts = ["a", "b", "e", " ", "  ", "\n", "▁", "th", "ing", "é", "ß", "的", "x", "Z", "!", "...", "<0x41>", "<s>", "😀", "́", "0", "\t", "==", "////", "----", "\x00"]
    for _ in range(6000):
        same("".join(rng.choice(parts) for _ in range(rng.randrange(30))))
    pieces = [lib.id_to_piece(i) for i in range(259, 32000)]
    for _ in range(6000):
        same("".join(rng.choice(pieces) for _ in range(rng.randrange(1, 8))))
    same("abc" * 20_000)
    assert spbpe.encode_documents(empty, path).count() == 0
    got = spbpe.encode_documents(edge, path, with_text=True).collect()
    texts = [t for _, t, _ in EDGE]
    assert len(got) == len(EDGE)
    for r in got:
        assert any(r.ids == lib.encode(t or "", add_bos=True, add_eos=True) and r.decoded == lib.decode(r.ids) for t in texts)


# -- 10 ----------------------------------------------------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(fps, radius=3):
    """Labels of components by brute force."""
    f = np.array(fps, np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= radius
    label = np.arange(len(f))
    while True:
        new = np.array([label[x].min() for x in near])
        if (new == label).all():
            return label
        label = new


def test_op10_equals_brute_force(spark, edge, empty, docs):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.near_duplicates(edge).count() == len(EDGE)
    rng = random.Random(4)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    for t in texts[:60]:  # near copies
        words = t.split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [None, "", " ", "A b", "a B"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(simhash.near_duplicates(df))
    fps = [fingerprint(t) for t in texts]
    label = linked(fps)
    assert len(set(label)) < len(set(fps))
    for i in range(len(texts)):
        assert got[i].fingerprint == f"{fps[i]:016x}" and got[i].component_id == label[i]


@pytest.mark.parametrize("big", [20_000, 3])
def test_op10_large_groups(spark, big):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flip = lambda n: np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    fps = np.unique(np.concatenate([base[rng.integers(0, 30, 1500)] ^ flip(1500) ^ flip(1500), rng.integers(0, 2**63, 500, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    comp = {r.node: r.comp for r in simhash.components(simhash.shard_edges(df, 3, big)).collect()}
    first, want, got = {}, linked(fps).tolist(), []
    for k, x in enumerate(fps.view(np.int64).tolist()):
        got.append(first.setdefault(comp.get(x, x), k))
    assert got == want


def test_op10_trees_follow_and_prune_edges():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[rng.integers(0, 300, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near, (base >> np.uint64(16)) << np.uint64(16)]))
    for leaf in (1, 4, simhash.LEAF):
        tree = simhash.BKTree(fps, leaf)
        found = {(i, j) for a, b in tree.links(np.arange(len(fps)), 3) for i, j in zip(a.tolist(), b.tolist())}
        want = set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3))))
        assert found == want and tree.followed > 0 and tree.pruned > 0
        if leaf == 1:  # an edge is followed if the query's distance to the pivot is within 3 of the edge's
            def walk(node, q):
                if not isinstance(node, tuple):
                    return 0, 0
                pivot, keys, children = node
                d = int(fps[q] ^ fps[pivot]).bit_count()
                took = [abs(d - int(k)) <= 3 for k in keys]
                below = [walk(c, q) for c, t in zip(children, took) if t]
                return sum(took) + sum(f for f, _ in below), len(took) - sum(took) + sum(p for _, p in below)

            counts = [walk(tree.root, q) for q in range(len(fps))]
            assert (tree.followed, tree.pruned) == (sum(f for f, _ in counts), sum(p for _, p in counts))


def test_op10_shards_build_nodes(spark):
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    fps = np.unique(np.concatenate([fps, fps[:800] ^ np.uint64(0b101 << 20)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for shard in (8, 512, 100_000):
        comp = {r.node: r.comp for r in simhash.components(simhash.shard_edges(df, 3, shard=shard)).collect()}
        assert len(comp) == 1600 and len(set(comp.values())) == 800
    assert any(isinstance(simhash.BKTree(part).root, tuple) for part in np.split(fps, 8))


def test_op10_hot_keys_are_spread(spark, monkeypatch):
    rows = [(i, "one text that many rows share with each other") for i in range(300)] + [(300 + i, f"text {i} with its own words w{i} x{i} y{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, simhash.near_duplicates(df).collect()))
    monkeypatch.setattr(simhash, "HOT", 5)
    assert simhash.hot_keys(df.groupBy("text").agg(F.count("doc_id").alias("n")), "text", 400) == [rows[0][1]]
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want
    monkeypatch.setattr(simhash, "MANY", 0)
    star = spark.createDataFrame([(k, 0) for k in range(1, 40)] + [(50, 51), (51, 52)], "a long, b long")
    assert {r.node: r.comp for r in simhash.components(star).collect()} == {**{k: 0 for k in range(40)}, 50: 50, 51: 50, 52: 50}


def test_one_of_each_is_exact_for_repeated_and_missing_ids(spark):
    a, b = "the first text of some words that stands alone here", "quite another text with nothing in common at all now"
    rows = [(5, a, "x"), (5, b, "x"), (3, b, "y"), (None, a, "z"), (None, "a third text which has no id whatever but words", "z"), (None, "a third text which has no id whatever but words", "y"), (7, None, "q"), (8, "", "q"), (5, a, "x"), (9, b, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for shuffled in (df, df.orderBy("source", F.desc("doc_id")), df.repartition(3)):
        for got in (jaccard.one_of_each(shuffled), simhash.one_of_each(shuffled)):
            assert sorted(map(tuple, got.collect()), key=str) == sorted([(5, a, "x"), (3, b, "y"), (7, None, "q"), (None, rows[4][1], min("yz", key=lambda s: hashlib.sha256(f'{{"text":"{rows[4][1]}","source":"{s}"}}'.encode()).hexdigest()))], key=str)


def test_large_groups_of_candidates_are_confirmed_by_blocks(spark, monkeypatch):
    rng = random.Random(12)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):  # a chain: each differs little from the one before, much from the first
        base[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(base)))
    df = spark.createDataFrame(rows + [(100, "alone " * 9)], "doc_id long, text string")
    want = sorted(map(tuple, jaccard.near_duplicates(df).collect()))
    monkeypatch.setattr(jaccard, "GROUP", 7)
    assert sorted(map(tuple, jaccard.near_duplicates(df).collect())) == want
    assert 2 <= len({c for _, c in want}) < 30


def test_wide_radius_misses_few():
    p = math.acos(8 / 9) / math.pi  # of a bit: equal sets at a Jaccard similarity of 0.8 share 8/9 of each
    beyond = sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(jaccard.RADIUS + 1, 65))
    assert beyond < 1e-8


# -- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, docs, edge, empty):
    import corpus_pipeline as pipeline

    now, seen = docs, []
    for name, stage in pipeline.STAGES:
        got = stage(spark, now, SF)
        seen.append(got.cache())
        if name != "sentencepiece":
            assert got.columns == docs.columns
        now = got
    lang, near, pii, mixed, ids = seen
    texts = {r.doc_id: r.text for r in lang.collect()}
    order = sorted(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((texts[d] or "").encode().lower().split() for d in order)]
    label = list(range(len(order)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if y == old else y for y in label]
    assert sorted(r.doc_id for r in near.collect()) == sorted({order[k] for k in label})
    assert pii.count() == near.count() and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in pii.collect()}
    assert sorted(map(str, ids.collect())) == sorted(map(str, spbpe.encode_documents(mixed, public_tokenizers.path("piece_bpe_32k.model")).collect()))
    assert sorted(map(str, pipeline.run(spark, SF).collect())) == sorted(map(str, ids.collect()))


def test_pipeline_edges(spark, edge, empty):
    import corpus_pipeline as pipeline

    for df in (edge.withColumn("n_chars", F.lit(1).cast("long")), empty.withColumn("n_chars", F.lit(1).cast("long"))):
        for name, stage in pipeline.STAGES:
            got = stage(spark, df, SF)
            assert got.count() <= 2 * df.count() + 2, name
