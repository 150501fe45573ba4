import io
import contextlib

from pyspark.sql import functions as F

from tablekit.session import scratch_path
from tablekit.sources import sinks as SNK
from tablekit.sources import files as SRC


def test_keyed_parquet_lookup_prunes_to_one_bucket(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    path = SNK.write_keyed_parquet(df, scratch_path(spark, "keyed-test"), "k", buckets=8)
    got = SNK.read_keyed(spark, path, "k", 1234, buckets=8)
    assert [(r.k, r.v) for r in got.collect()] == [(1234, 2468)]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "PartitionFilters: [isnotnull(bucket" in buf.getvalue()


def test_csv_strings_try_cast_and_quote_free_sink(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b")], "n string, s string")
    path = SNK.write_csv(df, scratch_path(spark, "csv-test"), header=True)
    back = SRC.read_csv_strings(spark, path, casts={"n": "int"}, keep_raw=True)
    assert sorted(((r.n, r.n_raw, r.s) for r in back.collect()), key=lambda t: t[2]) == [(1, "1", "a"), (None, "x", "b")]
    raw = SNK.write_csv(spark.createDataFrame([('say "hi"',)], "t string"), scratch_path(spark, "csv-raw"),
                        header=False, quote="")
    assert [r.value for r in spark.read.text(raw).collect()] == ['say "hi"']


def test_spread_rows_only_when_splits_are_few(spark):
    from tablekit.sources.tables import spread_rows
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1).withColumnRenamed("id", "k")
    spread = spread_rows(one, "k")
    assert spread.rdd.getNumPartitions() == cores
    assert sorted(r.k for r in spread.collect()) == list(range(1000))
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread_rows(many, "id") is many


def test_rows_source_infers_names_or_takes_a_schema(spark):
    assert SRC.rows_source(spark, [(1, "a")]).columns == ["_1", "_2"]
    assert SRC.rows_source(spark, [(1, "a")], ["k", "v"]).columns == ["k", "v"]
    typed = SRC.rows_source(spark, [(1, None)], "k int, v string")
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "string"]


def test_csv_line_breaks_need_the_option(spark):
    path = scratch_path(spark, "csv-lines")
    SNK.write_csv(spark.createDataFrame([(1, "a\nb")], "k int, v string"), path, header=True)
    assert SRC.read_csv_typed(spark, path, "k int, v string").count() == 2
    assert SRC.read_csv_typed(spark, path, "k int, v string", multi_line=True).collect()[0]["v"] == "a\nb"


HARD = ['plain', 'comma, inside', 'a "quoted" word', 'two\nlines', 'three\n\nlines, "and quotes"', '"', '""', '\n', 'ends with break\n',
        '\r\ncarriage', 'x' * 3000, 'long\n' * 400, 'é😀\n"ü"', ' spaced ']


def test_csv_records_across_splits(spark):
    rows = [(i, HARD[i % len(HARD)] + str(i), HARD[(i * 7) % len(HARD)]) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    path = SNK.write_csv(df.repartition(3), scratch_path(spark, "csv-hard"), header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 30
        back = SRC.read_csv_typed(spark, path, "k int, a string, b string", multi_line=True)
        whole = spark.read.csv(path, schema="k int, a string, b string", header=True, multiLine=True, quote='"', escape='"')
        assert sorted(map(str, back.collect())) == sorted(map(str, whole.collect())) and back.count() == 600
        # a record longer than many splits
        big = [(1, "y\n" * 20_000 + '"end"'), (2, "after")]
        one = SNK.write_csv(spark.createDataFrame(big, "k int, a string").coalesce(1), scratch_path(spark, "csv-big"))
        assert sorted(tuple(r) for r in SRC.read_csv_typed(spark, one, "k int, a string", multi_line=True).collect()) == big
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_records_like_the_whole_file_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,"a\nname"\r\n1,"x\r\ny"\r\n\r\n2,\r\n3,""\r\n4,"z"', newline="")
    (tmp_path / "b.csv").write_text("k,a\n5,'p\nq'\n", newline="")
    (tmp_path / "c.csv").write_text("")
    schema = "k int, a string"
    got = sorted(map(tuple, SRC.read_csv_typed(spark, f"{tmp_path}/a.csv", schema, multi_line=True).collect()))
    assert got == [(1, "x\r\ny"), (2, None), (3, None), (4, "z")]
    both = SRC.read_csv_typed(spark, f"{tmp_path}/[bc].csv", schema, multi_line=True, quote="'", escape="\\")
    assert [tuple(r) for r in both.collect()] == [(5, "p\nq")]
    no_header = SRC.read_csv_typed(spark, f"{tmp_path}/b.csv", "k string, a string", header=False, multi_line=True, quote="'", escape="'")
    assert sorted(tuple(r) for r in no_header.collect()) == [("5", "p\nq"), ("k", "a")]


def test_backslash_escapes_do_not_open_values(spark, tmp_path):
    (tmp_path / "e.csv").write_text('1,"say \\"hi\n there"\n2,"b"\n', newline="")
    got = SRC.read_csv_typed(spark, f"{tmp_path}/e.csv", "k int, a string", header=False, multi_line=True, escape="\\")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 'say "hi\n there'), (2, "b")]


def test_single_file_from_parallel_parts(spark):
    import os
    df = spark.range(0, 5000, numPartitions=7).select((4999 - F.col("id")).alias("id"), F.concat(F.lit('a "b", '), "id").alias("the, name"))
    path = SNK.write_csv(df, scratch_path(spark, "one.csv"), single_file=True, order=["id"])
    assert os.path.isfile(path) and not [f for f in os.listdir(os.path.dirname(path)) if f.startswith(os.path.basename(path) + "-parts")]
    lines = open(path).read().splitlines()
    assert lines[0] == 'id,"the, name"' and [int(x.split(",")[0]) for x in lines[1:]] == list(range(5000))
    back = spark.read.csv(path, header=True, escape='"', schema="id bigint, name string")
    assert back.filter(F.col("name") != F.concat(F.lit('a "b", '), (4999 - F.col("id")).cast("string"))).count() == 0
    import pytest
    with pytest.raises(ValueError):
        SNK.write_csv(df, path, single_file=True)
    SNK.write_csv(df.limit(0), path, mode="overwrite", single_file=True, header=False)
    assert os.path.getsize(path) == 0
    SNK.write_csv(df.limit(3), path, mode="ignore", single_file=True)
    assert os.path.getsize(path) == 0


def test_scatter_rows(spark):
    from tablekit.sources.tables import scatter_rows
    got = scatter_rows(spark.range(0, 500, 1, 1).union(spark.createDataFrame([(None,), (7,)], "id bigint")), "id")
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert got.rdd.getNumPartitions() >= tasks
    rows = [r["id"] for r in got.collect()]
    assert sorted(rows, key=lambda v: (v is None, v)) == sorted([*range(500), 7]) + [None]
    sizes = got.rdd.glom().map(len).collect()
    assert max(sizes) < 502 / 2
    assert scatter_rows(spark.range(0).select("id"), "id").count() == 0


def test_partial_ratio_of_edges_and_long_texts(spark):
    from pyspark.sql import functions as F
    from tablekit.functions.fuzzy import partial_ratio

    def plain(a, b):
        s, t = sorted((a, b), key=len) if len(a) != len(b) else (a, b)
        if not s:
            return 0

        def lev(x, y):
            row = list(range(len(y) + 1))
            for i, c in enumerate(x, 1):
                new = [i]
                for j, e in enumerate(y, 1):
                    new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != e)))
                row = new
            return row[-1]
        best = min(lev(s, t[j:j + len(s)]) for j in range(len(t) - len(s) + 1))
        return int((len(s) - best) * 100 / len(s) + 0.5)

    import random
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcé ") for _ in range(n))
    pairs = [("", ""), ("", "abc"), ("abc", "abc"), ("abc", "xabc"), ("ab", "x" * 16 + "ab"), ("ab", "x" * 15 + "ab")]
    pairs += [(word(rnd.randint(0, 12)), word(rnd.randint(0, 80))) for _ in range(60)]
    # the best window at, before and after a grid point, and as the last one
    pairs += [("hello", "z" * n + "hello" + "z" * m) for n in (14, 15, 16, 17, 31, 32, 33) for m in (0, 1, 16, 40)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)] + [(-1, None, "a"), (-2, "a", None)], "i int, a string, b string")
    got = {r["i"]: r["r"] for r in df.select("i", partial_ratio("a", F.col("b")).alias("r")).collect()}
    assert [got[i] for i in range(len(pairs))] == [plain(*p) for p in pairs]
    assert got[-1] is None and got[-2] is None
