"""Subjects: held-out accuracy on made documents, edges."""

import random

import numpy as np

from boardloom.llm import subjects as sj

TOPICS = {
    "musica": ["spartito", "orchestra", "melodie", "pianoforte", "ritmo e voce", "coro polifonico"],
    "sport": ["pallavolo mista", "corsa campestre", "orienteering", "torneo di calcetto", "nuoto", "resistenza"],
    "diritto": ["accesso agli atti", "clausole contrattuali", "responsabilità civile", "privacy", "contratto", "statuti"],
}
FRAMES = ["Il percorso comprende {}, {} e {}.", "Si richiede esperienza in {}.", "Gli incontri affronteranno {} nonché {}."]
PLAIN = ["Le domande dovranno pervenire entro maggio.", "La graduatoria sarà pubblicata all’albo.", "Referente: la segreteria."]


def document(rng, own):
    lines = [rng.choice(FRAMES).format(*rng.sample(TOPICS[s], 3)) for s in own for _ in range(3)] + rng.sample(PLAIN, 2)
    if rng.random() < 0.4:
        lines.append("Si ricorda che l’aula è occupata per {}.".format(rng.choice(TOPICS[rng.choice(list(TOPICS))])))
    rng.shuffle(lines)
    return rng.choice(["Home | Musica | Sport\n", ""]) + "\n".join(lines)


def corpus(n, seed):
    rng = random.Random(seed)
    return [(i, set(rng.sample(list(TOPICS), rng.choice([0, 1, 1, 1, 2])))) for i in range(n)], rng


def test_held_out(spark):
    truth, rng = corpus(900, 2)
    rows = [(i, document(rng, sorted(own)), "clash") for i, own in truth]
    docs = spark.createDataFrame([*rows, (5000, None, "c"), (5001, "", "c"), (5002, " \n", "c")], "doc_id bigint, text string, subject string")
    labels = spark.createDataFrame([(i, s) for i, own in truth[:400] for s in own], "doc_id bigint, subject string")
    names = spark.createDataFrame([("musica", "Strumenti, coro"), ("sport", "Gare"), ("diritto", None)], "subject string, description string")
    got = {}
    for r in sj.document_subjects(docs, labels, names).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    labelled = {i for i, own in truth[:400] if own}
    assert not labelled & got.keys() and not {5000, 5001, 5002} & got.keys()
    test = [(own, got.get(i, set())) for i, own in truth if i not in labelled]
    tp = sum(len(a & b) for a, b in test)
    assert 2 * tp / sum(len(a) + len(b) for a, b in test) > 0.95
    assert sj.document_subjects(docs.limit(0), labels, names).count() == 0
    assert sj.document_subjects(docs, labels.limit(0), names).count() >= 0


def test_bisecting_k_means_parts_clear_groups():
    rng = np.random.default_rng(1)
    centres = np.eye(6)[:4]
    x = np.concatenate([c + rng.normal(0, 0.05, (40, 6)) for c in centres])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    leaf = sj.bisect(x, 4)
    groups = [set(leaf[i * 40 : i * 40 + 40]) for i in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4
    assert set(sj.bisect(np.ones((20, 3)) / 3**0.5, 5)) == {0}


def test_passages():
    assert sj.passages("Uno due tre. Quattro cin-\nque sei; f0rma") == [["uno", "due", "tre"], ["quattro", "cinque", "sei"], ["forma", "<short>"]]
    assert sj.passages("") == []


def test_very_long_document():
    rng = random.Random(4)
    texts = [document(rng, [s]) for s in TOPICS for _ in range(20)]
    model = sj.fit(texts, [{s} for s in TOPICS for _ in range(20)], {s: "" for s in TOPICS}, {w: 3.0 for t in texts for p in sj.passages(t) for w in p})
    assert model.subjects_of("\n".join(document(rng, ["sport"]) for _ in range(3000))) == ["sport"]


def test_leaves_of_all_documents_decide(spark):
    truth, rng = corpus(600, 5)
    docs = spark.createDataFrame([(i, document(rng, sorted(own))) for i, own in truth], "doc_id bigint, text string").cache()
    labels = spark.createDataFrame([(i, s) for i, own in truth[:300] for s in own], "doc_id bigint, subject string")
    names = spark.createDataFrame([(s, "") for s in TOPICS], "subject string, description string")
    for clustered in (10_000, 300):
        model = sj.learn(docs, labels, names, clustered=clustered)
        sj.settle(sj.numbered(docs, model), model)
        assert model.members.sum() == sum(model.vector(r.text) is not None for r in docs.collect()) > 300
        text = document(rng, ["sport"])
        mass, leaves = model.mixture(text)
        assert np.allclose(mass, leaves @ model.leaf_subject) and model.subjects_of(text) == ["sport"]
    model.leaf_subject[:] = 0  # no leaf has a subject
    assert model.subjects_of(text) == []


def test_sparse_rows_equal_dense_ones():
    rng = np.random.default_rng(3)
    dense = rng.random((60, 9)) * (rng.random((60, 9)) < 0.4) + np.eye(9)[rng.integers(9, size=60)]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    rows = sj.Rows.of([(np.flatnonzero(r).astype(np.int32), r[r > 0]) for r in dense], 9)
    some = np.array([7, 3, 3])
    assert np.allclose(rows[some] @ dense[0], dense[some] @ dense[0]) and np.allclose(rows.mean(), dense.mean(axis=0)) and np.allclose(rows[5], dense[5])
    assert (sj.bisect(rows, 5) == sj.bisect(dense, 5)).all()


def test_terms_and_leaves_come_from_all_documents(spark):
    truth, rng = corpus(700, 6)
    rows = [(i, document(rng, sorted(own))) for i, own in truth]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").cache()
    labels = spark.createDataFrame([(i, s) for i, own in truth[:500] for s in own], "doc_id bigint, subject string")
    names = spark.createDataFrame([(s, "") for s in TOPICS], "subject string, description string")
    given = [(t, own) for (i, own), (_, t) in zip(truth[:500], rows, strict=False) if own]
    want = sj.weigh([t for t, _ in given], [own for _, own in given], {s: "" for s in TOPICS}, {})
    for clustered in (10_000, 200, 30):
        model = sj.learn(docs, labels, names, clustered=clustered)
        assert list(model.number) == list(want.number) and np.allclose(model.tells, want.tells)
        assert model.members.sum() == sum(model.vector(t) is not None for _, t in rows)
        trusted = sj.replace(model)
        trusted.centroids, trusted.leaf_subject = model.centroids, model.leaf_subject
        trusted._turn()
        sj.learn_trust(trusted, [t for t, _ in given], [own for _, own in given])
        assert trusted.trust == model.trust
        assert model.subjects_of(document(rng, ["sport"])) == ["sport"]
