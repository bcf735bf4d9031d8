"""The quality classifier learns in a task: the driver gets weights, not the sample's rows."""

import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from obsmill.llm import quality_classifier


def test_training_rows_stay_off_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.integers(40)}" for _ in range(30)), i % 2) for i in range(60)]
    docs, marks = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    frame, sent = type(docs), []

    def counted(name):
        plain = getattr(frame, name)

        def wrapped(self, *args, **more):
            out = plain(self, *args, **more)
            sent.append(len(out))
            return out

        return wrapped

    for name in ("collect", "toPandas"):
        monkeypatch.setattr(frame, name, counted(name))
    model, lone, none = (quality_classifier.fit(docs, m) for m in (marks, marks.where("label = 1"), marks.where("label > 1")))
    assert max(sent) <= 2
    made = []
    for _, text, label in rows:
        ids, n = np.unique(quality_classifier.features([text.encode()])[0], return_counts=True)
        made.append((ids.astype(np.uint32), n.astype(np.float32), label))
    made.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))
    want = quality_classifier.train(made)
    assert np.array_equal(model.weights, want.weights) and model.bias == want.bias
    assert lone.bias == 6.0 and not lone.weights.any()
    assert none.scores(["a", None]).tolist() == [0.5, 0.5]
