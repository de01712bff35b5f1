"""Files, tables, logs, reports, bundles and the stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from veristar.operators import lexicon as L
from veristar.operators import scoring as SC
from veristar.operators import training as TR
from veristar.operators.features import FEATURE_COLS, MODEL_COLS, STABLE_COLS, extract_features
from veristar.sources import columns, params, readers, schemas, writers
from veristar.streaming import incremental


def test_csv_spellings_and_quotes(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('category,rating,label,text_\n'
                    'Home,5.0,CG,"He said ""hi"",\nand left"\n'
                    'NA,nan,null,N/A\n'
                    'Toys,abc,OR," padded "\n')
    rows = [tuple(r) for r in readers.read_raw_file(spark, str(path)).collect()]
    assert rows == [("Home", 5.0, "CG", 'He said "hi",\nand left'), (None, None, None, None), ("Toys", None, "OR", " padded ")]


def test_csv_columns_in_any_order(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("label,text_,rating,extra\nCG,hello,4,x\n")
    df = readers.read_raw_file(spark, str(path))
    assert df.select("rating", "label", "text_", "extra").first() == (4.0, "CG", "hello", "x")


def test_csv_sink_keeps_results(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", ["x, y", "z"]), (2, 'q"q\nr', [])], "i int, t string, f array<string>")
    writers.write_csv(df, str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out")).orderBy("i").collect()
    assert [r["t"] for r in back] == [" a ", 'q"q\nr'] and back[0]["f"] == '["x, y","z"]'


def test_columns(spark):
    df = spark.createDataFrame([("x", "t", 4.0)], "extra string, text_ string, rating double")
    assert columns.normalize_columns(df).columns == ["rating", "review_text"]
    both = spark.createDataFrame([("x", "t")], "text_ string, review_text string")
    with pytest.raises(ValueError):
        columns.rename_aliases(both)
    assert columns.detect(["id", "Stars", "Content"], columns.TEXT_NAMES) == "Content"
    assert columns.detect(["id", "body"], columns.TEXT_NAMES) == "id"
    found = columns.as_reviews(spark.createDataFrame([("7", "good", "4")], "k string, Content string, STARS string"))
    assert found.columns == ["k", "review_text", "rating"] and found.first() == ("7", "good", 4.0)


def test_seed_once_with_fallback(spark, tmp_path):
    raw = spark.createDataFrame([("a", 5.0, "CG", "one"), ("b", 1.0, "OR", "two")], "category string, rating double, label string, text_ string")
    writers.write_csv(raw, str(tmp_path / "raw"))
    target, log = str(tmp_path / "table"), str(tmp_path / "log")
    sources = [str(tmp_path / "cleaned"), str(tmp_path / "raw")]
    assert writers.seed_if_empty(spark, target, [sources[0]], log) is None
    assert writers.seed_if_empty(spark, target, sources, log) == 2
    assert writers.seed_if_empty(spark, target, sources, log) is None
    table = spark.read.parquet(target)
    assert table.count() == 2 and table.select("review_id").distinct().count() == 2
    assert [f.dataType for f in table.schema] == [f.dataType for f in schemas.RAW_REVIEWS]
    assert table.where("ingested_at is null").count() == 0
    assert [r["message"] for r in spark.read.parquet(log).collect()] == ["Seeded 2 rows into raw_reviews."]


def test_cleaned_file_is_preferred(spark, tmp_path):
    for name in ("cleaned", "raw"):
        spark.range(1).write.csv(str(tmp_path / name))
    assert readers.first_existing(spark, [str(tmp_path / "cleaned"), str(tmp_path / "raw")]).endswith("cleaned")
    assert readers.first_existing(spark, [str(tmp_path / "none")]) is None


def test_log_ids_grow(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(3):
        writers.log_append(spark, path, "stage", f"m{i}")
    rows = spark.read.parquet(path).orderBy("log_id").collect()
    assert [r["message"] for r in rows] == ["m0", "m1", "m2"] and len({r["log_id"] for r in rows}) == 3


def test_default_time_and_lengths(spark):
    given = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(given,), (None,)], "logged_at timestamp")
    rows = schemas.with_default_time(df, "logged_at").collect()
    assert rows[0][0] == given and rows[1][0] > given
    assert schemas.too_long(spark.createDataFrame([("a" * 101,), ("b",), (None,)], "category string"),
                            {"category": schemas.MAX_CATEGORY}).count() == 1


def test_tables_are_created_once(spark, tmp_path):
    for name in schemas.TABLES:
        path = str(tmp_path / name)
        assert writers.ensure_table(spark, path, name).count() == 0
        assert writers.ensure_table(spark, path, name).columns == schemas.TABLES[name].names


def test_report_file(spark, tmp_path):
    rows = [{"position": i, "model": m, "accuracy": 0.5 + i, "precision": 0.1, "recall": 0.2, "f1_score": 0.3,
             "roc_auc": 0.4, "confusion_matrix": [[1, 2], [3, i]]} for i, m in enumerate(["Zeta", "Alpha"])]
    writers.write_report(TR.report_table(spark, rows), str(tmp_path / "report"))
    assert [r.asDict() for r in readers.read_report(spark, str(tmp_path / "report")).collect()] == rows


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text("Good\t1.9\t0.9\t[2, 1]\nbad\t-2.5\t0.6\t[-2]\nodd line\n")
    got = {r[0]: r[1] for r in params.read_lexicon(spark, str(tmp_path / "lexicon.txt")).collect()}
    assert got == {"good": 1.9, "bad": -2.5}
    (tmp_path / "stop.txt").write_text("The\nof\n\nof\n")
    assert {r[0] for r in params.read_token_list(spark, str(tmp_path / "stop.txt")).collect()} == {"the", "of"}


@pytest.fixture(scope="module")
def trained(spark):
    """Two classes that differ in wording and punctuation."""
    rows = []
    for i in range(240):
        fake = i % 2
        words = ("superb amazing wonderful deal buy!!!" if fake else "works fine after several months of use.")
        rows.append((i, f"{words} item{i % 7} note{i % 5}", 5.0 if fake else 3.0, "CG" if fake else "OR"))
    reviews = spark.createDataFrame(rows, "review_id long, review_text string, rating double, label string")
    features = extract_features(reviews, L.default_tables(spark))
    data = TR.training_set(features, reviews)
    prepared = TR.prepare(data, params.default_stop_words(), max_terms=50)
    models = TR.estimators(prepared.n_train, forest_trees=5, forest_depth=3, max_iter=30)
    return reviews, features, prepared, TR.compare(prepared, models)


def test_training_separates(trained):
    _, _, prepared, comparison = trained
    report = {r["model"]: r for r in comparison.report.collect()}
    assert list(report) == ["LogisticRegression", "SGDClassifier_LogLoss", "RandomForest", "LinearSVC"]
    assert all(r["roc_auc"] > 0.9 for r in report.values())
    assert comparison.best == "LogisticRegression" or report[comparison.best]["roc_auc"] > report["LogisticRegression"]["roc_auc"]
    assert prepared.n_train == 192 and prepared.test.count() == 48
    assert sum(map(sum, report["RandomForest"]["confusion_matrix"])) == 48


def test_bundle_scores_like_the_model(spark, trained, tmp_path):
    """Column arithmetic with the stored coefficients equals the ML model's probability."""
    reviews, features, prepared, comparison = trained
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        writers.load_bundle(spark, path)
    comparison.best = "LogisticRegression"
    writers.save_bundle(path, comparison, prepared)
    bundle = writers.load_bundle(spark, path)
    assert bundle.numerical_cols == FEATURE_COLS and bundle.model_name == "LogisticRegression"
    want = {r["review_id"]: r["probability"] for r in TR.predict(bundle.model, prepared.test).collect()}
    got = {r["review_id"]: r["probability"] for r in
           SC.score_linear(features, reviews, bundle.coefficients, bundle.stop_words).collect()}
    assert want and all(got[i] == pytest.approx(p, abs=1e-9) for i, p in want.items())
    assert TR.coefficients(comparison.models["RandomForest"], prepared).count() == 0
    ranked = TR.coef_ranking(bundle.coefficients, 5).collect()
    assert len(ranked) == 10 and {r["color"] for r in ranked} <= {"#EF4444", "#10B981"}
    summary = SC.scan_summary(SC.scan(reviews, L.default_tables(spark), bundle.coefficients, bundle.stop_words)).first()
    assert summary["total"] == 240 and abs(summary["deceptive"] - 120) < 12
    detail = SC.analyze(reviews.limit(1), L.default_tables(spark), bundle.coefficients, bundle.stop_words).first()
    assert set(detail["features"].asDict()) == set(FEATURE_COLS)


def test_forest_bundle_scores_with_the_forest(spark, trained, tmp_path):
    reviews, _, prepared, comparison = trained
    path, before = str(tmp_path / "forest"), comparison.best
    comparison.best = "RandomForest"
    writers.save_bundle(path, comparison, prepared)
    comparison.best = before
    bundle = writers.load_bundle(spark, path)
    with pytest.raises(ValueError):
        SC.scan(reviews, L.default_tables(spark), bundle.coefficients, bundle.stop_words)
    want = {r["review_id"]: r["probability"] for r in TR.predict(bundle.model, prepared.test).collect()}
    got = {r["review_id"]: r["deceptive_probability_pct"]
           for r in SC.scan_bundle(reviews, L.default_tables(spark), bundle).collect()}
    assert len(got) == 240 and all(got[i] == pytest.approx(100 * p, abs=0.006) for i, p in want.items())


def test_empty_scan(spark, trained):
    reviews, _, prepared, comparison = trained
    table = TR.coefficients(comparison.models["LogisticRegression"], prepared)
    scanned = SC.scan(reviews.limit(0), L.default_tables(spark), table, [])
    assert tuple(SC.scan_summary(scanned).first()) == (0, 0, 0, 0.0)


def test_stream_equals_batch(spark, tmp_path):
    schema = "review_id long, review_text string, rating double"
    first = spark.createDataFrame([(1, "good", 5.0), (2, "bad bad", 1.0), (2, "bad bad", 1.0)], schema)
    second = spark.createDataFrame([(2, "bad bad", 1.0), (3, "very good!", 4.0)], schema)
    tables = L.default_tables(spark)
    source, deltas, checkpoint = (str(tmp_path / n) for n in ("in", "deltas", "cp"))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_review_stream(spark, source, first.schema, files_per_batch=1)
        incremental.start_extraction(stream, tables, deltas, checkpoint, ["review_id"]).awaitTermination()
    got = incremental.current_features(spark, deltas)
    want = extract_features(first.unionByName(second).distinct(), tables)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    incremental.compact(spark, deltas, str(tmp_path / "compacted"))
    again = incremental.current_features(spark, str(tmp_path / "compacted"))
    assert sorted(again.select(want.columns).collect()) == sorted(want.collect())


def test_late_copies_are_dropped(spark, tmp_path):
    rows = [(1, "a", 5.0, datetime.datetime(2024, 1, 1)), (1, "a", 5.0, datetime.datetime(2024, 1, 1, 1)), (2, "b", 4.0, datetime.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating double, ingested_at timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.without_late_copies(incremental.read_review_stream(spark, str(tmp_path / "in"), df.schema))
    run = incremental.start_extraction(stream, L.default_tables(spark), str(tmp_path / "deltas"), str(tmp_path / "cp"),
                                       ["ingested_at"])
    run.awaitTermination()
    raw = spark.read.parquet(str(tmp_path / "deltas"))
    assert sorted(r["review_id"] for r in raw.collect()) == [1, 2]


@pytest.mark.parametrize("per_file", [1, 4])
def test_first_delivery_keeps_stable_columns_and_latest_sets_model_columns(spark, tmp_path, per_file):
    """The same result whether the deliveries come in one micro-batch or in four."""
    schema = "review_id long, review_text string, rating double, arrived int"
    rows = [(1, "zebra good. Fine!", 5.0, 1), (1, "middle words here", 3.0, 2), (1, "a bad bad thing", 1.0, 3),
            (2, None, 2.0, 1), (2, None, 2.0, 1), (3, "good", None, 2), (3, "very good!", 4.0, 2)]
    # Files in order of arrival; within one file the order is the other way round.
    parts = [[r for r in rows if r[3] == k] for k in (1, 2, 3)] if per_file == 1 else [rows[::-1]]
    source = str(tmp_path / "in")
    tables = L.default_tables(spark)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_review_stream(spark, source, spark.createDataFrame(rows, schema).schema)
        incremental.start_extraction(stream, tables, str(tmp_path / "deltas"), str(tmp_path / "cp"),
                                     ["arrived"]).awaitTermination()
    got = {r["review_id"]: r for r in incremental.current_features(spark, str(tmp_path / "deltas")).collect()}

    def alone(text, rating):
        df = spark.createDataFrame([(0, text, rating)], "review_id long, review_text string, rating double")
        return extract_features(df, tables).first()

    # Equal arrival: a missing rating sorts before a known one.
    for key, first, last in ((1, rows[0], rows[2]), (2, rows[3], rows[3]), (3, rows[5], rows[6])):
        stable, model = alone(*first[1:3]), alone(*last[1:3])
        assert [got[key][c] for c in STABLE_COLS] == [stable[c] for c in STABLE_COLS]
        assert [got[key][c] for c in MODEL_COLS] == [model[c] for c in MODEL_COLS]


def test_the_stream_of_a_table_of_one_file_and_of_several(spark, tmp_path):
    from veristar.plans.catalog import QUERIES

    docs = spark.createDataFrame([(i, f"The best text {i}. No doubt!" if i else None) for i in range(40)], "doc_id long, text string")
    found = []
    for name, files in (("several", 3), ("one", 1)):
        path = tmp_path / name / "documents.parquet"
        docs.repartition(files).write.parquet(str(path))
        if files == 1:
            file = next(path.glob("part-*.parquet")).read_bytes()
            path = tmp_path / "file" / "documents.parquet"
            path.parent.mkdir()
            path.write_bytes(file)
        found.append(sorted(map(tuple, QUERIES["stream_features"](spark, str(path.parent)).collect())))
    assert found[0] == found[1] and [r[0] for r in found[0]] == list(range(40))
