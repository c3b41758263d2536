import itertools
import zlib

import numpy as np
import pytest

from popdist.llm import crf, gru, quality, toxicity

SMALL = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(1)
    lengths = [1, 3, 4, 6]
    doc = np.repeat(np.arange(4), lengths)
    emit, trans = r.normal(size=(len(doc), 2)), r.normal(size=(2, 2))
    marginal, pairs, total = crf.forward_backward(emit, trans, doc, 4)
    want_z, want_pairs, at = 0.0, np.zeros((2, 2)), 0
    for n in lengths:
        e, weights = emit[at:at + n], {}
        for path in itertools.product((0, 1), repeat=n):
            weights[path] = np.exp(sum(e[i, p] for i, p in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        z = sum(weights.values())
        want_z += np.log(z)
        for i in range(n):
            assert np.isclose(marginal[at + i, 1], sum(w for p, w in weights.items() if p[i]) / z)
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += w / z
        at += n
    assert np.isclose(total, want_z) and np.allclose(pairs, want_pairs)


def test_line_features():
    lines = crf.line_features([b"", b"Ab 1!\nAb 1!", b"x x x\n\n", "é".encode()])
    assert lines.doc.tolist() == [0, 1, 1, 2, 2, 2, 3] and lines.weight.tolist() == [1, 6, 6, 6, 1, 1, 3]
    assert lines.own[2, 3] == 1 and lines.own[1, 3] == 0  # a line like the one before
    assert np.isclose(lines.own[3, 0], 2 / 3)  # two of three words repeat
    alone = crf.line_features([b"x x x\n\n"])
    assert np.allclose(alone.own, lines.own[3:6])
    both = crf.with_neighbours(lines)
    n = crf.N_OWN
    assert np.allclose(both[1, 2 * n:], lines.own[2]) and not both[1, n:2 * n].any()


def test_gradients_equal_differences():
    known = gru.read_words([b"a bb ccc ddddeee"])
    net = gru.BiGru(known.hash, np.unique(known.grams))
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    words = gru.read_words([b"a bb ccc zz a bb ddddeee", b"ccc q ddddee"])
    at, target = gru.word_windows(words).at, np.array([1.0, 0.0])

    def loss():
        p = gru._sigmoid(net.forward(net.inputs(words)[0].astype(float), at))
        return -(target * np.log(p + 1e-7) + (1 - target) * np.log(1 - p + 1e-7)).mean()
    _, g = net.gradients(words, at, target, np.ones(2))
    for k, w in net.p.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        w[i] += 1e-3
        up = loss()
        w[i] -= 2e-3
        down = loss()
        w[i] += 1e-3
        assert np.isclose(g[k][i], (up - down) / 2e-3, rtol=1e-3, atol=1e-6), k


def test_all_windows_of_long_texts_are_read():
    windows = gru.windows_of(np.repeat([0, 2], [5, 100]), 3)
    assert windows.doc.tolist()[0] == 0 and set(windows.at[windows.doc == 2].ravel().tolist()) - {-1} == set(range(5, 105))
    same = gru.read_words([b"One TWO", b"two one"])
    assert len(same.hash) == 2 and same.of[0] == same.of[3] != same.of[1] == same.of[2] and same.doc.tolist() == [0, 0, 1, 1]


def packed(text, n):
    return (n << 56) | sum(b << 8 * i for i, b in enumerate(text))


@pytest.mark.parametrize("text", [b"moron", b"a", b"abc", "日本語".encode(), b"xxxxxxxmoronxyz", b"q" * 33 + b"moron" + b"z" * 90,
                                  "たいへん長い文".encode() * 9])
def test_every_place_of_a_word_is_read(text):
    words = gru.read_words([b"", b" " + text + b".", b""])
    assert set(words.doc.tolist()) == {1}
    inside = {packed(text[i:i + n], n) for n in gru.SIZES for i in range(len(text) - n + 1)}
    assert inside <= set(words.grams.tolist())
    if len(text) <= gru.PIECE:
        whole = b"\0" + text + b"\0"
        assert set(words.grams.tolist()) == {packed(whole[i:i + n], n) for n in gru.SIZES for i in range(len(whole) - n + 1)}


def test_a_toxic_part_of_a_compound_is_found(labelled_docs, labels):
    net = toxicity.train(labelled_docs, labels)
    clean = [r.text for r in labelled_docs.collect() if "moron" not in r.text and "MORON" not in r.text][:20]
    for word in ("moron", "supermoronlike", "xxxxxxxmoronxyz", "qqqqqqqqqqqqqqqqqqqqqqqqqqqqqqqmoronqqqqqqqqqqqqqqqqqqqqq"):
        scores = net.score([f"{t[:40]} {word} {t[40:]}".encode() for t in clean])
        assert (scores >= toxicity.THRESHOLD).mean() >= 0.9, word
    assert (net.score([t.encode() for t in clean]) < toxicity.THRESHOLD).mean() >= 0.9


def plain_score(net, text):
    """The network written step by step, for one text."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    import re

    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower())
    vectors = []
    for w in words:
        one = gru.read_words([w])
        entry = {h: i + 1 for i, h in enumerate(net.vocabulary.tolist())}.get(int(one.hash[0]), 0)
        known = {h: i + 1 for i, h in enumerate(net.sequences.tolist())}
        found = [known[g] for g in one.grams.tolist() if g in known]
        chars = net.p["char"][found].sum(0) / np.sqrt(max(1, len(found))) if found else np.zeros(gru.CHAR_DIM)
        vectors.append(np.concatenate([net.p["word"][entry], chars]))
    best = -np.inf
    for a in range(0, max(1, len(words) - gru.WINDOW + gru.STRIDE), gru.STRIDE):
        part, both = vectors[a:a + gru.WINDOW], []
        for way in "fb":
            h, states = np.zeros(gru.HIDDEN), []
            for x in (part if way == "f" else part[::-1]):
                p, u, n = x @ net.p[f"w{way}"] + net.p[f"c{way}"], net.p[f"u{way}"], gru.HIDDEN
                gates = sig(p[:2 * n] + h @ u[:, :2 * n])
                c = np.tanh(p[2 * n:] + (gates[n:] * h) @ u[:, 2 * n:])
                h = h + gates[:n] * (c - h)
                states.append(h)
            both.append(states if way == "f" else states[::-1])
        states = np.concatenate(both, axis=1)
        e = np.exp(states @ net.p["att"] - (states @ net.p["att"]).max())
        best = max(best, (e / e.sum()) @ states @ net.p["out"] + net.p["bias"][0])
    return sig(best)


def test_scores_equal_a_plain_forward_pass(labelled_docs, labels):
    net = toxicity.train(labelled_docs, labels)
    texts = [r.text.encode() for r in labelled_docs.limit(6).collect()] + [b"one", b"moron " * 40, "é 中文 abc".encode()]
    assert np.allclose(net.score(texts), [plain_score(net, t) for t in texts], atol=1e-4)


@pytest.mark.parametrize("sf,least", [("0.01", 0.6), ("0.1", 0.9)])  # 37 and 329 toxic documents to learn from
def test_held_out_toxic_documents_are_found(spark, sf, least):
    folder = f"/root/testdata/sf{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    net = toxicity.train(docs, labels)
    rows = docs.join(labels, "doc_id").where(toxicity.held_out("doc_id")).select("text", "toxic").collect()
    said = net.score([(r.text or "").encode() for r in rows]) >= toxicity.THRESHOLD
    toxic = np.array([r.toxic for r in rows]) == 1
    assert said[toxic].mean() >= least and said[~toxic].mean() <= 0.05, (said[toxic].mean(), said[~toxic].mean())


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_made_labels(spark, labelled_docs, labels, odd_docs, module, label):
    got = {r.doc_id: r for r in module.classify(labelled_docs, labels).collect()}
    want = {r.doc_id: r[label] for r in labels.where("doc_id >= 1000").collect()}
    right = 0
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)
        right += r.predicted == want[i]
    assert right >= 0.95 * len(want)
    # odd rows are scored, each of them
    model = module.train(labelled_docs, labels)
    odd = odd_docs.withColumnRenamed("digest", "score")
    rows = (module.score(odd, model) if module is toxicity else odd.select("doc_id", module.scores(odd["text"], model))).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r[-1] <= 1 for r in rows)
    # no labels, labels of one kind, no documents
    for some in (labels.where("false"), labels.where(f"{label} = 1")):
        assert len({r.score for r in module.classify(labelled_docs, some).collect()}) == 1
    assert module.classify(labelled_docs.where("false"), labels).count() == 0


def test_held_out_labels_are_not_learnt(labelled_docs, labels):
    from pyspark.sql import functions as F

    from popdist.llm.labelled import held_out

    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.classify(labelled_docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.classify(labelled_docs, flipped).collect()}
    assert a == b


def test_quality_of_held_out_documents(spark):
    from popdist.llm.queries import op4_quality

    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    told = [(r.predicted, truth[r.doc_id]) for r in op4_quality(spark, SMALL).collect() if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in told) >= 0.93 * len(told)


def test_long_documents_are_learnt_from_too(spark, labelled_docs, labels):
    from pyspark.sql import functions as F

    long = labelled_docs.withColumn("text", F.expr("repeat(concat(text, '\n'), 60)"))
    assert long.where("char_length(text) <= 8000").count() == 0
    sample = quality.labelled_lines(long, labels, "quality")
    assert sample.label.nunique() == 2 and sample.text.str.len().between(6_000, 8_000).all()
    want = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.classify(long, labels).collect()
    assert sum(r.predicted == want[r.doc_id] for r in got) > 110
    good = sum(want[r.doc_id] for r in got)
    assert abs(quality.keep_good(long, labels).count() - good) < 10


def test_labels_of_one_kind_or_none_reject_nothing_by_default(labelled_docs, labels):
    for some in (labels.where("false"), labels.where("quality = 1")):
        assert quality.keep_good(labelled_docs, some).count() == labelled_docs.count()
    assert {r.score for r in quality.classify(labelled_docs, labels.where("quality = 0")).collect()} == {0.0}


def test_labels_without_documents_take_no_place(spark, labelled_docs, labels):
    more = labels.union(spark.range(10 ** 6, 10 ** 6 + 5000).selectExpr("id doc_id", "1 quality", "0 toxic"))
    assert len(quality.labelled_lines(labelled_docs, more, "quality", 50)) == 50


def test_lines_come_from_all_over_a_long_text():
    from popdist.llm.labelled import some_lines

    lines = [f"line {i} " + "x" * 60 for i in range(5000)]
    got = some_lines("\n".join(lines)).split("\n")
    places = [lines.index(x) for x in got]
    assert places == sorted(places) and len(places) > 90 and places[0] < 500 and places[-1] > 4500
    one = some_lines("y" * 100_000)
    assert 6_000 < len(one) <= 8_000 and some_lines("short") == "short"
