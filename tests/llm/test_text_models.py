import random

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from sheafline.llm import bpe, langid, quality, tokencount, toxicity
from sheafline.llm.common import Scratch, held_out
from sheafline.llm.queries import BPE_PATH, PIECES_PATH

SF = "/root/testdata/sf0.01"
ODD = "ab eé\n\t  'stñ日本語😀.,!?09  \x1c\x85İßthe ing ll re"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(BPE_PATH), special_tokens={})


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 200").fetchall()


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_bpe_equals_the_merges(reference, documents):
    enc = bpe.Encoder(BPE_PATH, P.PATTERN)
    for t in [*texts(1, 3000), *(t for _, t in documents), "abcab" * 5000, " " * 300, "\n\n x", ""]:
        joined = enc.ids_text(t)
        ids = reference.encode_ordinary(t)
        assert enc.ids(t).tolist() == ids, t[:60]
        assert "".join(enc.machine.decode(joined, 3)) == "".join(enc.machine.decode(joined)) == t
    rows = [*texts(5, 500), *(t for _, t in documents)]
    assert [bpe.ids_of(j).tolist() for j in enc.joined(rows)] == [reference.encode_ordinary(t) for t in rows]


def test_bpe_settles_within_the_longest_token(reference):
    """A piece of any length is emitted part by part, and what is held doesn't grow with it."""
    fst = bpe.Transducer(bpe.load_ranks(BPE_PATH))
    rng = random.Random(8)
    for t in ["abcab" * 4000, "w" * 9001, "".join(rng.choice("aeéñlstr日") for _ in range(20000))]:
        read, most, out = 0, 0, []

        def feed(data):
            nonlocal read
            for byte in data:
                read += 1
                yield byte

        for part in fst.tokens(feed(t.encode())):
            out += part
            most = max(most, read - sum(fst.lengths[x] for x in out))
        assert out == reference.encode_ordinary(t) == fst.piece(t.encode()) and most <= 4 * fst.longest


def test_utf8_stream():
    for data in (bytes([a, b, c]) for a in (0x41, 0xC1, 0xC3, 0xE0, 0xED, 0xEF, 0xF4, 0xF5, 0x80) for b in range(0x70, 0xD0, 3) for c in (0x41, 0x80, 0xBF)):
        s = bpe.Utf8Stream()
        try:
            got = s.push(data)
            s.close()
        except UnicodeDecodeError:
            got = None
        assert got == (data.decode("utf-8", "ignore") if data.decode("utf-8", "replace").count("\ufffd") == 0 else None)
    data = "aé日😀".encode()
    for cut in range(1, len(data)):
        s = bpe.Utf8Stream()
        assert "".join(s.push(data[i : i + cut]) for i in range(0, len(data), cut)) == "aé日😀"
        s.close()
    s = bpe.Utf8Stream()
    s.push("é".encode()[:1])
    with pytest.raises(UnicodeDecodeError):
        s.close()
    with pytest.raises(UnicodeDecodeError):
        bpe.Utf8Stream().push(b"\xff\xff\xff\xff")


def test_bpe_frame(spark, reference):
    # extra columns stay, columns of the new names are replaced, nulls and repeats are rows like others
    df = spark.createDataFrame([(1, "the é", "x"), (1, "the é", "x"), (None, None, None), (2, "", "y")], "doc_id long, text string, n_tokens string")
    got = bpe.round_trip(df, BPE_PATH, P.PATTERN).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [0, len(reference.encode_ordinary("the é"))] + [len(reference.encode_ordinary("the é")), 0] and all(r.round_trip for r in got)
    assert got[0].ids_sha256 == got[0].decoded_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert bpe.encode_ids(df, BPE_PATH, P.PATTERN).where("ids is null").count() == 0
    assert bpe.round_trip(df.limit(0), BPE_PATH, P.PATTERN).count() == 0


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_token_counts(rule, reference):
    enc = bpe.Encoder(BPE_PATH, P.PATTERN)
    rng = random.Random(4)
    for t in texts(2, 300):
        cuts = sorted(rng.sample(range(len(t) + 1), min(3, len(t) + 1)))
        sections = [(f"s{i}", a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        got = {s["section"]: s["n_tokens"] for s in tokencount.attribute(t, enc.ids(t), enc.fst.length, sections, rule)}
        # brute force: the characters of each byte of each token
        char_of = [i for i, c in enumerate(t) for _ in c.encode()]
        home = lambda c: next((s for s, a, b in sections if a <= c < b), None)
        want = {s: 0 for s, _, _ in sections} | {None: 0}
        at = 0
        for token in reference.encode_ordinary(t):
            n = len(reference.decode_single_token_bytes(token))
            held = [home(char_of[i]) for i in range(at, at + n)]
            pick = held[0] if rule == "first" else held[-1] if rule == "last" else max(dict.fromkeys(held), key=held.count)
            want[pick] += 1
            at += n
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_token_counts_frame(spark):
    df = spark.createDataFrame([(1, "a title\nbody text\n"), (2, None), (3, "")], "doc_id int, text string")
    got = {r.doc_id: {s.section: s.n_tokens for s in r.sections} for r in tokencount.count_sections(df, BPE_PATH, P.PATTERN).collect()}
    assert got[2] == got[3] == {"title": 0, "body": 0} and got[1]["title"] > 1 and got[1]["body"] > 1
    with pytest.raises(ValueError):
        tokencount.count_sections(df, BPE_PATH, P.PATTERN, rule="none")


def brute_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(documents):
    rng = random.Random(6)
    small = ["".join(rng.choice("ab  \n\t#é") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for t in [None, "", " ", "a b c a b c", "x\n\nx\nx ", *small, *(t for _, t in documents if len(t) < 1500)]:
        assert quality.count_text(t) == brute_counts(t), t


def test_quality_frame(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(i, clean + f" z{i}", "en", "s") for i in range(250)] + [(900, clean.replace(" ", "# "), "en", "s"), (901, clean, None, None), (902, None, "en", None), (902, None, "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("clash")).withColumn("other", F.lit(1))
    for keep in (True, False):
        got = quality.judge(df, Scratch(spark, "t"), keep_text=keep)
        assert ("text" in got.columns) == keep and "other" in got.columns and got.count() == 254
        kept = {r.doc_id: r.kept for r in got.collect()}
        assert not kept[900] and kept[901] and not kept[902] and all(kept[i] for i in range(250))
    assert quality.judge(df.limit(0), Scratch(spark, "t")).count() == 0


def test_sketches_merge(spark):
    values = [random.Random(8).randint(0, 5000) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b"))
    assert all(r.b <= r.v and r.v - r.b <= r.v / 32 for r in df.collect())
    sk = df.select(F.lit("m").alias("measure"), F.col("b").alias("bucket")).groupBy("measure", "bucket").agg(F.count("*").alias("n"))
    q = quality.quantiles(sk, [], {"q": 0.5}).first().q
    assert abs(q - sorted(values)[999]) <= sorted(values)[999] / 16


def test_marginals_are_those_of_enumeration():
    rng = np.random.default_rng(1)
    model = toxicity.Field({}, 0.0, 0.3, ((0.1, -0.4), (0.2, 0.7)))
    rows = [rng.normal(size=n) for n in (5, 1, 0, 3, 7)]
    got = toxicity.marginals(rows, model)
    for e, p in zip(rows, got):
        total, on = 0.0, np.zeros(len(e))
        for bits in range(1 << len(e)):
            tags = [bits >> k & 1 for k in range(len(e))]
            w = np.exp(sum(x * y for x, y in zip(e, tags)) + (model.start * tags[0] if tags else 0) + sum(model.trans[a][b] for a, b in zip(tags, tags[1:])))
            total += w
            on += w * np.array(tags)
        assert np.allclose(p, on / total) if len(e) else len(p) == 0


def test_toxicity(spark):
    rng = random.Random(3)
    words = ["alpha", "bravo", "delta", "echo", "golf", "hotel", "india", "kilo", "lima", "mike"]
    rows, labels = [], []
    for i in range(600):
        ws = [rng.choice(words) for _ in range(rng.randint(5, 40))]
        bad = i % 3 == 0
        if bad:
            ws[rng.randrange(len(ws))] = rng.choice(["Vilword,", "nastyone", "nastytwo!"])
        rows.append((i, "É " + " ".join(ws)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (5000, None), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(spark, docs.where(~held_out(docs, 5, 0)), lab, Scratch(spark, "t"))
    out = toxicity.tag(docs.withColumn("score", F.lit("clash")), model)
    got = {r.doc_id: r for r in out.where(held_out(out, 5, 0)).collect()}
    assert got and all(r.predicted == dict(labels)[d] for d, r in got.items())
    for d, r in got.items():
        assert all(r.text[s.start : s.end].lower().startswith(("vilword", "nasty")) for s in r.spans) and bool(r.spans) == bool(r.predicted)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "?? !"), (4, "vilword " * 20000)], "doc_id long, text string")
    assert [round(r.score, 3) for r in toxicity.tag(odd, model).orderBy("doc_id").collect()] == [0, 0, 0, 1]
    empty = toxicity.fit(spark, docs, lab.limit(0), Scratch(spark, "t"))
    assert toxicity.tag(docs, empty).where("score > 0.01").count() == 0
    assert toxicity.tag(docs.limit(0), model).count() == 0


def test_forward_sums_all_segmentations():
    pieces, prefixes = langid.vocabulary(PIECES_PATH)
    rng = np.random.default_rng(2)
    prob = rng.random((len(pieces) + 1, 2)) / 100

    def total(w, lang):
        if not w:
            return 1.0
        out = sum(prob[pieces[w[:k]], lang] * total(w[k:], lang) for k in range(1, len(w) + 1) if w[:k] in pieces)
        return out + (0 if w[0] in pieces else prob[-1, lang] * total(w[1:], lang))

    words = ["the", "chat", "größe", "x", "日本"]
    _, like = langid.forward(words, langid.arcs(words, pieces, prefixes), prob)
    for k, w in enumerate(words):
        assert np.allclose(like[k], [np.log(total(langid.MARK + w, lang)) for lang in (0, 1)])
        assert np.allclose(like[k], langid.forward_long(w, pieces, max(map(len, pieces)), prob))


def test_forward_of_long_words():
    """Nothing underflows, and 48 characters are no border."""
    pieces, prefixes = langid.vocabulary(PIECES_PATH)
    longest = max(map(len, pieces))
    prob = np.full((len(pieces) + 1, 2), 1e-9)
    for n in (40, 48):
        w = "ꙮ" * n
        _, like = langid.forward([w], langid.arcs([w], pieces, prefixes), prob)
        assert np.allclose(like, langid.forward_long(w, pieces, longest, prob)) and np.allclose(like, (n + 1) * np.log(1e-9))
    rng = np.random.default_rng(3)
    prob = rng.random(prob.shape) / 1000
    scorer = langid.Scorer(langid.Model(["a", "b"], prob, PIECES_PATH))
    words = ["lalangue" * 6, "lalangue" * 6 + "x", "lalangue" * 700]
    got = scorer.likelihoods(words)
    assert np.allclose(got[0, :2], langid.forward_long(words[0], pieces, longest, prob)) and (np.diff(got[:, 0]) < 0).all()


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    train = docs.where(~held_out(docs, 3, 1))
    model = langid.fit(train.withColumn("lang", F.when(F.col("doc_id") % 50 != 0, F.col("lang"))), PIECES_PATH, Scratch(spark, "t"))
    out = langid.predict(docs.where(held_out(docs, 3, 1)), model)
    assert out.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 — ??"), (4, "le " * 30000), (5, "x" * 5000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "fr" and 0 <= got[5][1] <= 1
    none = langid.fit(train.limit(0), PIECES_PATH, Scratch(spark, "t"))
    assert langid.predict(odd, none).where("lang_pred != 'und'").count() == 0
