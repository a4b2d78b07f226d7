"""Quality rules, language profiles, toxicity and secrets: brute force and held-out accuracy."""

import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import langid, quality_rules, secrets, spans, toxicity
from shelfmark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", None, 0),
    (3, " \t\n\x0b ", None, "a", 5),
    (None, "a b c d e a b c d e", "en", "a", 19),
    (4, "Ein Satz\nEin Satz\n\n ein # Satz|", "de", "b", 30),
    (4, "Ein Satz\nEin Satz\n\n ein # Satz|", "de", "b", 30),
    (5, "wort wort \U0001f600 " * 30_000, "de", "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeated rows, a long text, and columns that clash with the results."""
    return spark.createDataFrame(ODD, SCHEMA).withColumns(
        {"score": F.lit("mine"), "KEPT": F.lit("mine"), "_row": F.lit(1), "s": F.lit(2)}
    )


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(windows)
    inside = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(docs):
    texts = [r.text for r in docs.collect()] + [r[1] for r in ODD[:-1]]
    for text in texts:
        assert quality_rules.text_stats(text) == brute_stats(text)


def test_word_hashes_depend_on_the_word_alone():
    a, b, c, d = spans.word_hashes("Eins zwei  eins\tZwei")
    assert a == c and b == d and a != b
    assert len(spans.shingle_set("a b", 4)) == 1 and len(spans.shingle_set(None, 4)) == 0


def test_quality_rules_keep_good_and_drop_bad_documents(spark, docs):
    folder = "/root/testdata/sf0.1"
    judged = QUERIES["op9_quality_rules"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = judged.join(labels, "doc_id").where("not base_failed")
    share = {r["quality"]: r["s"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.98 and share[0] < 0.1
    failed = judged.where("base_failed != (n_words < 10 or 100 * n_repeat_words > 20 * n_words) or (base_failed and kept)")
    assert failed.isEmpty()


def test_quality_rules_on_odd_rows(odd, no_docs):
    found = quality_rules.apply_rules(odd, None)
    assert [c.lower() for c in found.columns].count("kept") == 1
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(ODD) and rows[1].base_failed and rows[3].n_words == 0
    assert rows[4].n_symbols == 2 and rows[4].n_dup_lines == 1
    assert rows[5].n_repeat_words == 60_000 and not rows[5].kept
    assert quality_rules.apply_rules(no_docs, None).count() == 0


def test_language_is_found_in_held_out_documents(spark, docs):
    found = QUERIES["op3_language_id"](spark, FOLDER)
    held = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    for r in found.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1


def test_grams_equal_brute_force():
    def brute(text):
        found = Counter()
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            found.update(word)
            padded = f" {word} "
            for n in (2, 3):
                found.update(padded[k : k + n] for k in range(len(padded) - n + 1))
        return sorted(found.values())

    for text in ("Ein Satz, ein 2. Satz!", "a", "x1y", "Été à l'île", "123 --"):
        counts = np.unique(langid.gram_codes(text), return_counts=True)[1]
        assert sorted(counts.tolist()) == brute(text)


def test_marks_and_digits_are_no_letters(spark, odd):
    df = spark.createDataFrame([(1, "\u0301 1 \u0301"), (2, "2 \u20e3")], "doc_id bigint, text string")
    assert {(r.lang_pred, r.score) for r in langid.identify(df, odd).collect()} == {("und", 0.0)}


def test_only_so_many_languages_are_learned(spark):
    rows = [(k, f"wort{k % 3} der die das", "de") for k in range(9)] + [(100 + k, "the of and", f"odd{k}") for k in range(50)]
    learn = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = langid.learn_profiles(learn, "text", "lang", 300, 2000, "doc_id", 3)
    assert sorted(known) == ["de", "odd0", "odd1"]
    found = {r.lang_pred for r in langid.identify(learn, learn, most_langs=1).collect()}
    assert found == {"de"}


def brute_language(texts, learned, size=300):
    """Rank-order profiles with plain lists."""

    def ranks(counts):
        return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]

    def grams(text):
        found = Counter()
        for word in "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split(" "):
            if word:
                found.update(word)
                padded = f" {word} "
                for n in (2, 3):
                    found.update(padded[k : k + n] for k in range(len(padded) - n + 1))
        return found

    counts = defaultdict(Counter)
    for text, lang in learned:
        if text is not None and lang is not None:
            counts[lang].update(grams(text))
    profiles = {lang: {g: r for r, g in enumerate(ranks(c))} for lang, c in counts.items()}
    found = []
    for text in texts:
        own = ranks(grams(text or ""))
        scored = [
            (sum(abs(p[g] - r) if g in p else size for r, g in enumerate(own)), lang) for lang, p in profiles.items()
        ]
        if own and scored:
            d, lang = min(scored)
            found.append((lang, round(1 - d / (size * len(own)), 9)))
        else:
            found.append(("und", 0.0))
    return found


def test_ranks_distances_and_predictions_equal_brute_force(spark, docs):
    rows = docs.orderBy("doc_id").limit(150).collect()
    learned = rows[:100]
    learn = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in learned], "doc_id bigint, text string, lang string")
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id bigint, text string")
    found = [(r.lang_pred, round(r.score, 9)) for r in langid.identify(df, learn).orderBy("doc_id").collect()]
    assert found == brute_language([r.text for r in rows], [(r.text, r.lang) for r in learned])


def test_language_of_odd_rows(odd, no_docs):
    rows = {r.doc_id: r for r in langid.identify(odd, odd).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[3].lang_pred == "und"
    assert rows[5].lang_pred == "de" and rows[1].score == 0
    assert {r.lang_pred for r in langid.identify(odd, no_docs).collect()} == {"und"}
    assert langid.identify(no_docs, odd).count() == 0


def test_toxic_documents_are_found_in_held_out_rows(spark):
    found = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = found.where("held_out").join(labels, "doc_id")
    share = {r["toxic"]: r["p"] for r in held.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert share[1] > 0.75 and share[0] < 0.01
    assert found.where("score not between 0 and 1 or predicted != int(score >= 0.3)").isEmpty()


def test_toxicity_of_odd_rows(spark, odd, no_docs):
    labelled = odd.select("doc_id", "text", F.lit(1).alias("label"))
    assert toxicity.score_toxicity(odd, labelled).where("score is null").isEmpty()
    nothing = no_docs.select("doc_id", "text", F.lit(1).alias("label"))
    assert {r.score for r in toxicity.score_toxicity(odd, nothing).collect()} == {0.5}
    assert toxicity.score_toxicity(no_docs, labelled).count() == 0


def test_ftrl_drops_what_does_not_matter():
    rng = np.random.default_rng(0)
    model = toxicity.Ftrl(1.0, 1.0, 4.0, 0.1)
    for _ in range(2000):
        noise, y = rng.integers(10, 5000, 20), int(rng.integers(2))
        model.learn(np.unique(np.append(noise, 3 if y else 4)), y)
    w = model.weights(np.arange(5000))
    assert w[3] > 1 and w[4] < -1 and (w[10:] != 0).mean() < 0.05


def test_candidates_equal_brute_force(docs):
    found = secrets.candidates(docs).where("kind = 'run'").select("doc_id", "at", "start", "value").collect()
    want = [
        (r.doc_id, i, w.start() + m.start(), m[0])
        for r in docs.collect()
        for i, w in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", r.text or ""))
        for m in re.finditer(secrets.RUN, w[0])
    ]
    assert sorted(map(tuple, found)) == sorted(want)


def test_secrets_are_found_and_words_are_not(spark, docs):
    found = QUERIES["op8_secret_scan"](spark, FOLDER)
    got = {(r.doc_id, r.value) for r in found.collect()}
    want = {
        (r.doc_id, v)
        for r in docs.collect()
        for v in re.findall(r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}", r.text)
    }
    assert want and want <= got
    assert not [v for _, v in got - want if v.isalpha()]


def test_secrets_with_given_labels(spark, no_docs):
    rows = [(i, f"the key = k3yA{i:04d}xQ9zPLm7Rt2 and word averylongplainwordtoo next") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, f"k3yA{i:04d}xQ9zPLm7Rt2", 1) for i in range(30)] + [(i, "averylongplainwordtoo", 0) for i in range(30)]
    labelled = spark.createDataFrame(labels, "doc_id bigint, value string, label int")
    found = secrets.scan(df, labelled).collect()
    assert len(found) == 60 and all(r.value.startswith("k3y") for r in found)
    assert secrets.scan(no_docs).count() == 0


def test_short_and_broken_secrets_are_candidates(spark, no_docs):
    cases = [
        ('set password = "hunter2!" now', 3, "hunter2!"),
        ("pwd=Kx9.mP2$vL", 0, "Kx9.mP2$vL"),
        ('my "passwd": "two words" end', 2, "two words"),
        ("see ftp://bob:s3c!t@host here", 1, "s3c!t"),
        ("a token: abc1 b", 2, "abc1"),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "doc_id bigint, text string")
    found = secrets.assigned(df).collect()
    assert sorted((r.doc_id, r.at, r.value) for r in found) == [(k, *c[1:]) for k, c in enumerate(cases)]
    assert {r.doc_id: r.right for r in found} == {0: "now", 1: "", 2: "end", 3: "here", 4: "b"}
    rows = [(i, f'the password = "h{i}!x" and the secret: word next') for i in range(60)]
    labels = [(i, f"h{i}!x", 1) for i in range(30)] + [(i, "word", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secrets.scan(df, spark.createDataFrame(labels, "doc_id bigint, value string, label int"))
    assert {(r.doc_id, r.value) for r in found.collect()} == {(i, f"h{i}!x") for i in range(60)}


def test_sample_of_findings_is_bounded_in_one_document(spark, monkeypatch):
    taken = []
    keep = secrets.hand_over

    def count(df, name):
        found = keep(df, name)
        taken.extend([found.count()] if name == "findings" else [])
        return found

    monkeypatch.setattr(secrets, "hand_over", count)
    rows = [(None, k, f"v{k}", k % 2, *[float(k % 7)] * len(secrets.FEATURES)) for k in range(2000)]
    schema = "doc_id bigint, start bigint, value string, label int, " + ", ".join(f"{f} double" for f in secrets.FEATURES)
    df = spark.createDataFrame(rows, schema)
    secrets.score_findings(df.drop("label"), df, per_label=100, trees=2, depth=2)
    assert len(taken) == 1 and 120 < taken[0] < 280


def test_secrets_of_odd_rows(odd):
    assert secrets.scan(odd).count() == 0


def test_features_equal_brute_force(docs):
    """Words, neighbours and words with one between, of the whole text and nothing else."""
    texts = [r.text for r in docs.limit(40).collect()] + ["Ein WORT_zwei drei-4 äöü", "a", "a b", "", None]
    for text in texts:
        w = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", (text or "").lower())
        expected = set()
        for k in range(len(w)):
            expected.update(toxicity.hashed_features(" ".join(w[k : k + 3])).tolist())
        assert toxicity.hashed_features(text).tolist() == sorted(expected)
    abc, ab, bc = (set(toxicity.hashed_features(t).tolist()) for t in ("a b c", "a b", "b c"))
    assert len(ab) == 3 and len(abc) == 6 and len(abc - ab - bc) == 1


def brute_ftrl(samples, epochs, alpha, beta, l1, l2):
    """Weights by feature, one coordinate after the other; the feature None is the bias."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        rest = abs(z[f]) - (0 if f is None else l1)
        if rest <= 0:
            return 0.0
        return -rest * (1 if z[f] > 0 else -1) / ((beta + n[f] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for x, y in samples:
            w = {f: weight(f) for f in [*x, None]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for f in w:
                z[f] += g - ((n[f] + g * g) ** 0.5 - n[f] ** 0.5) / alpha * w[f]
                n[f] += g * g
    return {f: weight(f) for f in list(z)}


def test_toxicity_equals_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        toxic = int(rng.integers(3) == 0)
        pool = ["bad", "worse", "worst"] if toxic else ["good", "fine", "nice"]
        w = [f"w{k}" for k in rng.integers(0, 40, 12)] + list(rng.choice(pool, 4))
        rows.append((i, " ".join(rng.permutation(w).tolist()), toxic))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    place = F.xxhash64(F.lit("order"), "doc_id", "text")
    ordered = df.select(place.alias("p"), "label", "text").orderBy("p", "label").collect()
    samples = [(toxicity.hashed_features(r.text).tolist(), r.label) for r in ordered]
    weights = brute_ftrl(samples, 5, 2.0, 1.0, 0.5, 0.1)
    found = toxicity.score_toxicity(df.select("doc_id", "text"), df, l1=0.5).collect()
    for r in found:
        total = weights[None] + sum(weights[f] for f in toxicity.hashed_features(r.text).tolist())
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
    assert len({round(r.score, 6) for r in found}) > 50


def test_path_lengths_equal_brute_force():
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=(60, 2)), np.zeros((5, 2)), [[9.0, 9.0]]]
    trees = [quality_rules.grow_tree(x, seed) for seed in range(30)]

    def mean_path(n):
        return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def path(nodes, row):
        """The depth at which a row stands and the path expected among the rows still beside it."""
        at, depth, beside = 0, 0, list(x)
        while nodes[at][0] >= 0:
            f, cut = int(nodes[at][0]), nodes[at][1]
            values = [r[f] for r in beside]
            assert min(values) <= cut < max(values)
            left = row[f] <= cut
            beside = [r for r in beside if (r[f] <= cut) == left]
            at, depth = int(nodes[at][2 if left else 3]), depth + 1
        assert depth <= 7 and (depth == 7 or len({tuple(r) for r in beside}) == 1)
        return depth + mean_path(len(beside))

    expected = [2 ** (-np.mean([path(t, row) for t in trees]) / mean_path(len(x))) for row in x]
    forest = quality_rules.IsolationForest([np.array(t) for t in trees], mean_path(len(x)))
    assert forest.score(x) == pytest.approx(np.array(expected), abs=1e-12)
    assert int(np.argmax(expected)) == len(x) - 1


@pytest.mark.parametrize("keep", [0.5, 0.9, 0.995, 1.0])
def test_threshold_equals_brute_force(spark, keep):
    rng = np.random.default_rng(7)
    scores = rng.beta(3, 5, 500).tolist()
    found = quality_rules.calibrate(spark.createDataFrame([(s,) for s in scores], "anomaly double"), keep)
    limits = [b / 10_000 for b in range(10_001)]
    least = next(t for t in limits if sum(int(s * 10_000) < round(t * 10_000) for s in scores) >= keep * 500)
    assert found == least
