"""Features of the training sample go to the driver as numbers."""

import pyarrow as pa

from veristar.llm import secrets


def test_features_go_as_numbers(spark, monkeypatch):
    rows = [(i, f"key{i % 9} = v_{i}\npassword: hunter{i % 5}hunter2 and word{i % 3}") for i in range(400)] + [(500, None), (501, "_")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kinds = []
    coded = secrets.Chains.coded.__func__
    monkeypatch.setattr(secrets.Chains, "coded", classmethod(lambda cls, f, *a: (kinds.append(f.type), coded(cls, f, *a))[1]))
    got = secrets.sample(docs)
    assert kinds and all(pa.types.is_integer(k.value_type.value_type) for k in kinds)
    want = []
    for _, text in rows:
        if text:
            base = secrets.base_spans(text)
            runs = secrets.windows(text)
            want += [([f + secrets.file_features(text, base) for f in secrets.run_features(text, run)], secrets.tags_of(run, base)) for run in runs]
    want = secrets.Chains.listed(sorted(want))
    assert got.features == want.features
    for name in ("places", "per_token", "tags", "lengths"):
        assert getattr(got, name).tolist() == getattr(want, name).tolist()
