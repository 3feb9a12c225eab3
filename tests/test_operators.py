import duckdb
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import archive, checks, config, digest, labels, names, pairing, splits
from tessera.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, df[cols].astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), duck.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_metric_stream(spark):
    got = catalogue.metric_stream(spark, SF)
    want = catalogue.metric_extract(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("metric", "metric_value").collect()))


@pytest.mark.parametrize("total,want", [(503, [352, 76, 75]), (100, [70, 15, 15]), (3, [1, 1, 1]), (20, [14, 3, 3]), (10, [7, 2, 1])])
def test_quotas(spark, total, want):
    got = splits.quotas(spark.createDataFrame([("a", total)], "stratum string, n long")).orderBy("split_index").collect()
    assert [r.quota for r in got] == want


def test_quotas_equal_the_sequential_rule(spark):
    def sequential(total, ratios):
        exact = [total * r for r in ratios]
        out = [int(x) for x in exact]
        for i in sorted(range(3), key=lambda i: (-(exact[i] - out[i]), i))[: total - sum(out)]:
            out[i] += 1
        while 0 in out:
            giver = max(range(3), key=lambda i: (out[i], -i))
            out[giver] -= 1
            out[out.index(0)] += 1
        return out

    for ratios in ((0.7, 0.15, 0.15), (0.98, 0.01, 0.01), (0.2, 0.4, 0.4)):
        got = splits.quotas(spark.createDataFrame([(n, n) for n in range(3, 150)], "stratum long, n long"), ratios).orderBy("stratum", "split_index").collect()
        for n in range(3, 150):
            assert [r.quota for r in got if r.stratum == n] == sequential(n, ratios), (n, ratios)


@pytest.mark.parametrize("ratios", [(0.8, 0.2, 0.2), (float("nan"), 0.2, 0.8), (0, 0.5, 0.5), (-1, 1, 1)])
def test_bad_ratios(ratios):
    with pytest.raises(ValueError):
        splits.checked_ratios(ratios)


def test_split_keeps_groups_together_in_both_modes(spark):
    df = spark.createDataFrame([(f"n{i}", "a" if i % 3 else "b", f"d{i // 2}{i % 3 == 0}") for i in range(120)], "name string, stratum string, digest string")
    for mode in ("hash", "compat"):
        got = splits.assign(df, "stratum", "digest", "name", mode=mode)
        assert got.count() == 120
        assert digest.leaks(got, "split", d="digest").count() == 0


def test_round_robin_compat():
    got = list(splits.round_robin_compat([[1, 2, 3], [10], [], [20, 21]], 5, 7))
    assert len(got) == 5 and {10, 20, 21} <= set(got) and list(splits.round_robin_compat([[1]], 5, 7)) == [1]


def test_names(spark):
    df = spark.createDataFrame([("a.b.JPG",), (".hid",), ("x",), ("é ü.png",)], "n string")
    got = df.select(names.stem(F.col("n")), names.suffix(F.col("n")), names.output_name(F.lit("c"), F.lit("normal"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("a.b", ".JPG", "c_normal_a_b.jpg"), (".hid", "", "c_normal__hid"), ("x", "", "c_normal_x"), ("é ü", ".png", "c_normal____.png")]
    assert spark.range(1).select(names.inside(F.lit("/a/b"), F.lit("/a")), names.inside(F.lit("/ab"), F.lit("/a"))).first()[:] == (True, False)


def test_conflicts_count_nulls(spark):
    df = spark.createDataFrame([("x", "a", None), ("x", "a", "m"), ("y", "a", None), ("y", "a", None)], "d string, c string, m string")
    assert [r.d for r in digest.conflicts(df, "d", "c", "m").collect()] == ["x"]


def test_label_lines_keep_negatives(spark):
    images = spark.createDataFrame([("train", "a"), ("train", "b"), ("val", "c")], "split string, key string")
    files = spark.createDataFrame([("a", "0 .5 .5 .1 .1\n\n0 .4 .4 .1 .1\n"), ("b", "  \n"), ("c", "")], "key string, value string")
    got = {r.split: r for r in labels.split_stats(images, labels.lines(files), "key").collect()}
    assert (got["train"].positive, got["train"].negative, got["train"].boxes, got["val"].negative) == (1, 1, 2, 1)
    assert {r.split for r in labels.one_class_only(spark.createDataFrame(list(got.values()))).collect()} == {"val"}


def test_archive_members(spark, tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name in ("weights/best.pt", "../bad", "/tmp/bad", "C:/bad", "weights/best.pt"):
            info = tarfile.TarInfo(name)
            info.size = 4
            tar.addfile(info, io.BytesIO(b"best"))
        link = tarfile.TarInfo("link")
        link.type, link.linkname = tarfile.SYMTYPE, "x"
        tar.addfile(link)
    got = archive.read_members(spark.read.format("binaryFile").load(str(tmp_path)), with_content=True)
    found = {r.n: r.fault for r in archive.guarded(got, "path", "n").collect()}
    assert [found[i] for i in range(6)] == [None, "parent", "absolute", "colon", "duplicate", "type"]
    assert archive.totals(got, "path").first().bytes == 20


def test_config_overlay():
    base = {"schema_version": 1, "training": {"epochs": 60, "batch": 1}}
    assert config.overlay(base, {"training": {"batch": 4}}) == {"schema_version": 1, "training": {"epochs": 60, "batch": 4}}
    for bad in ({"x": 1}, {"training": 3}, {"training": {"y": 1}}):
        with pytest.raises(checks.DatasetError):
            config.overlay(base, bad)
    assert config.dotted({"a": {"b": True}, "c": 2}) == [("a.b", "true"), ("c", "2")]


def test_checks_raise_with_reasons(spark):
    files = spark.createDataFrame([("a.png", False), ("A.PNG", False), ("sub", True), (".x", True), ("m.jpg", False), ("Thumbs.db", False)], "name string, is_dir boolean")
    with pytest.raises(checks.DatasetError) as e:
        checks.raise_if_any(checks.listing(files, masks=True))
    assert all(x in str(e.value) for x in ("ambiguous_stem", "nested_dir", "lossy_mask_format"))
    checks.raise_if_any(checks.listing(files.filter("name = 'a.png'"), masks=True))


def test_inventory_and_pairs(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    assert sorted((r.k, r.side) for r in pairing.inventory_difference(a, b).collect()) == [(1, "missing"), (2, "missing"), (3, "unexpected")]
    assert sorted((r.k, r.status) for r in pairing.pair_status(a, b, "k").collect()) == [(1, "missing_mask"), (2, "matched"), (3, "extra_mask")]


def test_leakage_group_of_texts_in_several_languages(spark, tmp_path):
    """Texts in several languages leak, rows without a language count for nothing; the SQL leaves the order of splits open."""
    rows = [(3 * k + i, f"t{k}", lang) for k in range(60) for i, lang in enumerate(("en", ("fr", "en")[k % 2], (None, "de")[k % 3 == 0]))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = {r.digest: r.splits for r in catalogue.leakage_group(spark, str(tmp_path)).collect()}
    want = {d: sorted(s.split(",")) for _, d, s in c.sql(catalogue.ORACLES["leakage_group"]).fetchall()}
    assert 0 < len(want) < 60 and {d: ",".join(s) for d, s in want.items()} == got
