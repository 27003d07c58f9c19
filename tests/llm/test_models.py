"""Language and quality: held-out accuracy, folds, odd rows, what a filter keeps."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airledger.llm import language, quality
from airledger.llm.sampling import labelled_sample

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def tongue(corpus):
    return language.train(corpus)


@pytest.fixture(scope="module")
def judge(corpus, labels):
    return quality.train(corpus, labels)


def test_language_of_held_out_documents(corpus, tongue):
    got = language.predict(corpus, tongue).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == corpus.count()
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98


def test_language_learns_nothing_from_the_held_out_fold(corpus, tongue):
    spoiled = corpus.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang"))
    )
    assert language.train(spoiled).languages == tongue.languages == ["de", "en", "es", "fr"]


def test_kernel_is_the_share_of_common_sequences():
    def places(text):
        return set(np.flatnonzero(language.presence([text])[0]).tolist())

    texts = ["eine kleine Katze", "the small cat", "une petite chatte"]
    model = language.fit(texts, ["de", "en", "fr"])
    got = model.kernel(language.presence(["eine katze"]))[0]
    own = places("eine katze")
    want = [len(own & places(t)) / (len(own) * len(places(t))) ** 0.5 for t in texts]
    assert np.allclose(sorted(got), sorted(want), atol=1e-5)
    long = "a bc" * (language.PIECE // 2)  # read piece by piece
    assert places(long) == places("a bc" * 50)


def test_language_of_odd_rows(odd, empty, tongue):
    got = language.predict(odd, tongue).collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id in (1, 2, 3)}
    assert len(got) == odd.count()
    for row in got:
        if row.doc_id in texts:
            assert (row.lang_pred, row.score) == ("und", 0.0)
    assert {r.lang_pred for r in got if r.doc_id in (4, 5, 6)} == {"en"}
    assert language.predict(empty, tongue).count() == 0
    nothing = language.train(odd)  # no row has a language
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    kept = language.identified(odd, nothing)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-9, 4, 5, 5, 6, 7, 7, 8]


def test_language_filter_keeps_documents(corpus, tongue):
    assert language.identified(corpus, tongue).count() == corpus.count()


def test_quality_of_held_out_documents(corpus, labels, judge):
    got = quality.predict(corpus, judge).join(labels, "doc_id", "left").collect()
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [r for r in got if r.held_out and r.quality is not None]
    right = {q: np.mean([r.predicted == q for r in held if r.quality == q]) for q in (0, 1)}
    assert right[1] > 0.97 and right[0] > 0.85


def test_quality_learns_nothing_from_the_held_out_fold(corpus, labels, judge):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    spoiled = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    text = ["Some words of a text, and a few more."]
    assert np.allclose(quality.train(corpus, spoiled).scores(text), judge.scores(text))


def test_temperature_calibrates():
    draw = np.random.default_rng(3)
    logits = draw.normal(0, 1, 20_000)
    good = (draw.random(20_000) < 1 / (1 + np.exp(-logits))).astype(float)
    assert quality.temperature(3 * logits, good) == pytest.approx(3, rel=0.15)


def test_pooling_is_the_mean_over_tokens():
    vectors = quality.learn_vectors(["one two three", "two ### three THREE three three"])
    places, shapes = quality.token_codes("two ### two two")
    assert places.size == 4 and shapes.tolist()[-1] % 2 == 1
    pooled = vectors.pool("two ### two two")
    assert np.allclose(pooled[: quality.WIDTH], vectors.words[places].mean(axis=0), atol=1e-5)
    assert not quality.Vectors(vectors.words, vectors.shapes).pool("").any()


def test_quality_of_odd_rows(spark, odd, empty, judge, labels):
    got = quality.predict(odd, judge).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.predict(empty, judge).count() == 0
    broken = spark.createDataFrame(
        [(None, 1), (4, None), (5, 7), (999, 1)], "doc_id bigint, quality int"
    )
    plain = quality.train(odd, broken)
    assert {r.score for r in quality.predict(odd, plain).collect()} == {0.5}
    assert quality.train(empty, labels).scores(["x"]).tolist() == [0.5]
    kept = quality.good_enough(odd, judge)
    assert kept.columns == odd.columns


def test_quality_filter_keeps_good_documents(corpus, labels, judge):
    kept = quality.good_enough(corpus, judge).select("doc_id")
    lost = labels.filter("quality = 1").join(kept, "doc_id", "left_anti").count()
    assert lost <= 0.02 * labels.filter("quality = 1").count()
    assert kept.count() < corpus.count()


def test_copies_do_not_crowd_out_the_sample(spark):
    rows = [(i, "der gleiche Satz" if i % 3 else f"ein anderer Satz mit der Zahl {i} und mehr", "de") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = labelled_sample(frame, "label", ["text"], per_label=50, max_labels=5, carry=["text"])
    assert len(got) == len({r.text for r in got}) and 15 <= len(got) <= 50


@pytest.mark.parametrize("texts, copies", [(20, 1000), (49, 1), (50, 40), (301, 3), (2000, 10)])
def test_the_sample_is_full_however_often_texts_repeat(spark, texts, copies):
    rows = spark.range(texts * copies).selectExpr(f"concat('Satz mit der Zahl ', id % {texts}) AS text", "'de' AS label")
    rows = rows.unionAll(spark.range(5000).selectExpr("concat('sentence ', id)", "'en'"))
    got = labelled_sample(rows, "label", ["text"], per_label=50, max_labels=5, carry=["text"])
    drawn = {name: [r.text for r in got if r.label == name] for name in ("de", "en")}
    assert len(set(drawn["de"])) == len(drawn["de"]) == min(50, texts) and len(set(drawn["en"])) == len(drawn["en"]) == 50
    once = labelled_sample(rows.distinct(), "label", ["text"], per_label=50, max_labels=5, carry=["text"])
    assert [(r.label, r.text) for r in once] == [(r.label, r.text) for r in got]


def test_a_language_of_copies_is_learned(spark):
    basque = [f"hau da euskarazko {i}garren esaldia eta ez du beste inork ulertzen" for i in ("bi", "hiru", "lau", "bost", "sei")]
    rows = [(i, basque[i % 5], "eu") for i in range(6000)]
    rows += [(10_000 + i, f"the sentence number {i} of the english texts in this table", "en") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    assert model.languages == ["en", "eu"]
    assert {r.lang_pred for r in language.predict(frame.filter("lang = 'eu'"), model).collect()} == {"eu"}


def test_every_language_is_learned(spark):
    draw = np.random.default_rng(5)
    names = [f"l{i:02}" for i in range(70)]
    words = {n: ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(12)] for n in names}
    rows = [(n, " ".join(draw.choice(words[n], 30))) for place, n in enumerate(names) for _ in range(10 + place)]
    frame = spark.createDataFrame([(i, t, n) for i, (n, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.train(frame)
    assert model.languages == names and model.landmarks.shape[1] == 4 * 70
    got = language.predict(frame, model).join(frame, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, f"satz {i} in einer sprache, die nur lang geschrieben wird " * 600, "de") for i in range(20)]
    rows += [(100 + i, f"a sentence {i} that is short", "en") for i in range(200)]
    rows += [(400 + i, f"another sentence {i} that is long " * 900, "en") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    assert model.languages == ["de", "en"]
    assert {r.lang_pred for r in language.predict(frame.filter("lang = 'de'"), model).collect()} == {"de"}
    label = frame.selectExpr("lang AS label", "text", "length(text) > 20000 AS long")
    for wanted, long in ((100, 0), (210, 10), (500, 20)):
        got = labelled_sample(label, "label", ["text"], per_label=wanted, max_labels=None, carry=["text"], later=F.col("long"))
        sizes = [len(r.text) > 20_000 for r in got if r.label == "en"]
        assert len(sizes) == min(wanted, 220) and sum(sizes) == long and sizes == sorted(sizes)


def test_quality_learns_from_labelled_documents_whatever_else_is_labelled(spark, corpus, labels, judge):
    foreign = spark.range(400_000).selectExpr("id + 10000000 AS doc_id", "cast(id % 2 as int) AS quality")
    model = quality.train(corpus, labels.select("doc_id", "quality").unionByName(foreign))
    texts = [r.text for r in corpus.limit(50).collect()]
    assert np.allclose(model.scores(texts), judge.scores(texts))


def test_repeated_rows_are_learned_from_once(spark, corpus, labels, judge):
    many = corpus.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("copy"))
    texts = [r.text for r in corpus.limit(50).collect()]
    assert np.allclose(quality.train(many, labels).scores(texts), judge.scores(texts))


def test_long_texts_serve_where_a_class_has_no_others(spark):
    rows = [(i, "good words make a text of sentences " * 900, 1) for i in range(60)]
    rows += [(100 + i, "%%% ### buy now $$$ 111 " * 5, 0) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert len(rows[0][1]) > quality.MAX_CHARS
    model = quality.train(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    good, bad = model.scores([rows[0][1], rows[-1][1]])
    assert good > 0.7 > 0.3 > bad


def test_tokens_alike_at_their_start_differ():
    first, second = (quality.token_codes("x" * 100 + end)[0][0] for end in "ab")
    assert first != second


def test_word_vectors_equal_a_plain_version():
    """Sums of the index vectors of the tokens (and shapes) within the window, written out token by token."""
    texts = ["one two three one", "Two ### ### 12 three", ""]
    made = quality.learn_vectors(texts)
    word_index, shape_index = quality.index_vectors(quality.PLACES, 11), quality.index_vectors(quality.SHAPES, 12)

    def vector(index, row):
        out = np.zeros(quality.WIDTH)
        for place, sign in zip(index[0][row], index[1][row]):
            out[place] += sign
        return out

    words, shapes = {}, {}
    for text in texts:
        place, shape = (x.tolist() for x in quality.token_codes(text))
        for i in range(len(place)):
            own = words.setdefault(place[i], vector(word_index, place[i]))
            own_shape = shapes.setdefault(shape[i], vector(shape_index, shape[i]))
            for j in range(max(0, i - quality.WINDOW), min(len(place), i + quality.WINDOW + 1)):
                if j != i:
                    own += vector(word_index, place[j]) + vector(shape_index, shape[j])
                    own_shape += vector(shape_index, shape[j])
    for made_rows, plain in ((made.words, words), (made.shapes, shapes)):
        for row, want in plain.items():
            size = np.linalg.norm(want)
            assert np.allclose(made_rows[row], want / (size or 1), atol=1e-5)
    unseen = next(p for p in range(quality.PLACES) if p not in words)
    assert np.allclose(made.words[unseen], vector(word_index, unseen) / np.linalg.norm(vector(word_index, unseen)), atol=1e-5)


def test_network_equals_a_plain_forward_pass(judge):
    texts = ["Some plain words of a text.", "### $$$ 111", ""]
    net, got = judge.network, judge.scores(texts)
    for text, score in zip(texts, got):
        row = judge.vectors.pool(text)
        hidden = [
            np.tanh(sum((row[i] - net.mean[i]) / net.scale[i] * net.w1[i, h] for i in range(len(row))) + net.b1[h])
            for h in range(len(net.b1))
        ]
        logit = (sum(x * w for x, w in zip(hidden, net.w2)) + net.b2) / judge.temperature + judge.shift
        assert score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-6)


def test_training_steps_follow_the_numeric_gradient(monkeypatch):
    """One step of the fit moves every parameter against the sign of the loss's numeric gradient."""
    draw = np.random.default_rng(4)
    rows, good = draw.normal(size=(40, 5)), (draw.random(40) < 0.5).astype(float)
    monkeypatch.setattr(quality, "STEPS", 0)
    start = quality.fit_network(rows, good)
    monkeypatch.setattr(quality, "STEPS", 1)
    moved = quality.fit_network(rows, good)

    def loss(net):
        logits = net.logits(rows)
        penalty = quality.DECAY / 2 * ((net.w1**2).sum() + (net.w2**2).sum())
        return np.logaddexp(0, np.where(good > 0, -1, 1) * logits).mean() + penalty

    for name in ("w1", "w2"):
        values = getattr(start, name)
        for place in list(np.ndindex(values.shape))[:: max(1, values.size // 25)]:
            gradient = 0.0
            for sign in (1, -1):
                changed = quality.Network(start.mean, start.scale, start.w1.copy(), start.b1, start.w2.copy(), start.b2)
                getattr(changed, name)[place] += sign * 1e-5
                gradient += sign * loss(changed) / 2e-5
            if abs(gradient) > 1e-5:
                assert np.sign(getattr(moved, name)[place] - values[place]) == -np.sign(gradient)


def test_ridge_regression_equals_a_plain_version():
    """The fitted margins solve the weighted ridge regression on the landmark features, written out in the primal."""
    draw = np.random.default_rng(8)
    names = ["de", "en", "fr"]
    words = {n: ["".join(draw.choice(list("abcdefgh"), 4)) for _ in range(9)] for n in names}
    labels = [n for n in names for _ in range(14 + 5 * names.index(n))]
    texts = [" ".join(draw.choice(words[n], 12)) for n in labels]
    model = language.fit(texts, labels, landmarks=12)
    cross = model.kernel(language.presence(texts)).astype(np.float64)
    chosen = [int(np.argmax(cross[:, k])) for k in range(cross.shape[1])]
    assert np.allclose(cross[chosen, range(len(chosen))], 1, atol=1e-5)  # a landmark is most like itself
    square = cross[chosen]
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    kept = values > 1e-6 * values[-1]
    features = cross @ (vectors[:, kept] / np.sqrt(values[kept]))
    weight = np.array([1 / labels.count(n) for n in labels])
    weight *= len(labels) / weight.sum()
    want = np.empty((len(texts), len(names)))
    for place, name in enumerate(names):
        target = np.array([1.0 if n == name else -1.0 for n in labels])
        # Ordinary least squares over rows stretched by their weights, an unpenalised constant and rows for the penalty.
        penalty = np.sqrt(language.RIDGE * len(labels) / len(names))
        design = np.column_stack([features, np.ones(len(labels))]) * np.sqrt(weight)[:, None]
        ridge = np.hstack([penalty * np.eye(features.shape[1]), np.zeros((features.shape[1], 1))])
        solved, *_ = np.linalg.lstsq(np.vstack([design, ridge]), np.r_[target * np.sqrt(weight), np.zeros(features.shape[1])], rcond=None)
        want[:, place] = np.column_stack([features, np.ones(len(labels))]) @ solved
    assert np.allclose(cross @ model.weights + model.bias, want, atol=1e-3)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 5)
    frame = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.train(frame)
