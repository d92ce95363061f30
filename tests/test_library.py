import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from aggstate.functions import bytesx as B
from aggstate.functions import estimates as E
from aggstate.functions import quantile_bytes as QB
from aggstate.functions import registers as R
from aggstate.operators import quantiles as Q
from aggstate.operators import states as S
from aggstate.operators.table import AggregatingTable
from aggstate.sources import catalog, connect, remote
from aggstate.streaming import views

SF = "/root/testdata/sf0.001"


def test_every_query_agrees_with_sql(spark):
    import duckdb

    from aggstate.plans import registry, relational, streams, verification

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    for module in (registry, relational, verification, streams):
        assert set(module.ORACLE) == set(module.QUERIES)
        for name, query in module.QUERIES.items():
            assert rows(query(spark, SF).toPandas()) == rows(con.sql(module.ORACLE[name]).df()), name


@pytest.mark.parametrize(("number", "code"), [(0, "00"), (127, "7F"), (128, "8001"), (300, "AC02"), (16383, "FF7F"), (16384, "808001"), (2649, "D914"), ((1 << 63) - 1, "FFFFFFFFFFFFFFFF7F")])
def test_leb128(spark, number, code):
    row = spark.range(1).select(F.lit(number).cast("bigint").alias("n")).select(F.hex(B.leb128(F.col("n"))).alias("c"), B.leb128_value(B.leb128(F.col("n"))).alias("v")).first()
    assert (row.c, row.v) == (code, number)


def test_row_binary_fields(spark):
    row = spark.sql("SELECT 'café' AS s, CAST(null AS string) AS n, TIMESTAMP'2015-09-12 00:00:00.9' AS t, -1L AS i, 1.5D AS d, '' AS e").select(
        F.hex(B.rb_string(F.col("s"))), F.hex(B.rb_nullable_string(F.col("n"))), F.hex(B.rb_nullable_string(F.col("e"))), F.hex(B.rb_datetime(F.col("t"))), F.hex(B.rb_int64(F.col("i"))), F.hex(B.rb_float64("d")), B.tsv_row(F.col("s"), F.col("n"), F.lit("a\tb\\c\n"))
    ).first()
    assert list(row) == ["05636166C3A9", "01", "0000", (1442016000).to_bytes(4, "little").hex().upper(), "FF" * 8, "000000000000F83F", "café\t\\N\ta\\tb\\\\c\\n"]


@pytest.mark.parametrize("k", [12, 15, 16, 20])
def test_combined_states_round_trip(k):
    values = np.random.default_rng(k).integers(0, 70, 1 << k)
    state = R.encode_combined(values, k)
    assert len(state) == {12: 3291, 15: 24783, 16: 49357, 20: 786621}[k]
    kept = R.decode_combined(state, k)
    assert (kept == np.minimum(values, 65 - k)).all()
    histogram, zeros = R.combined_trailer(state, k)
    assert histogram.sum() == 1 << k and zeros == (values == 0).sum() % (1 << (16 if k < 16 else 32))
    with pytest.raises(ValueError):
        R.decode_combined(state[:-1], k)


def test_small_state_layout():
    values = np.arange(4096) % 30
    state = R.encode_hll12(values)
    assert len(state) == 2651 and state[0] == 1
    assert (R.decode_hll12(state) == np.minimum(values, 21)).all()
    for wrong in (np.zeros(4095), np.zeros(4097), np.full(4096, -1)):
        with pytest.raises(ValueError):
            R.encode_hll12(wrong)
    with pytest.raises(ValueError):
        R.decode_hll12(b"\0\x01" + b"\0" * 8)
    assert R.hll12_small(b"\0\x01" + (7).to_bytes(8, "little")).tolist() == [7]


def test_integer_hash_and_ranks():
    assert R.int_hash64([0])[0] == 0
    assert int(R.int_hash64([0x4CF2D2BAAE6DA887])[0]) == 4761183170873013810
    bucket, rank = R.buckets_and_ranks(np.array([5, 5 | 1 << 12, 5 | 1 << 14], np.uint64), 12)
    assert bucket.tolist() == [5, 5, 5] and rank.tolist() == [53, 1, 3]


def test_estimates_and_folds():
    registers = R.native_registers(R.int_hash64(np.arange(1, 1001)), 14)
    assert abs(R.estimate(registers) / 1000 - 1) < 0.03
    assert (R.fold(registers, 12) == registers.reshape(4, -1).max(0)).all()
    assert (R.union(registers, registers) == registers).all()
    with pytest.raises(ValueError):
        R.fold(registers, 15)
    with pytest.raises(ValueError):
        R.target_k(11)
    assert R.target_k(21) == 20


@pytest.mark.parametrize("kind", ["HLL_4", "HLL_6", "HLL_8"])
@pytest.mark.parametrize("n", [3, 100, 50000])
def test_sketches_of_all_types_have_the_same_registers(spark, kind, n):
    hll = spark._jvm.org.apache.datasketches.hll
    make = lambda t: hll.HllSketch(12, getattr(hll.TgtHllType, t))
    a, b = make(kind), make("HLL_8")
    for i in range(n):
        a.update(i)
        b.update(i)
    one, other = (R.sketch_registers(bytes(s.toCompactByteArray())) for s in (a, b))
    assert (one == other).all() and one.max() > 0
    assert R.preamble(bytes(a.toCompactByteArray()))["type"] == kind
    assert abs(R.estimate(one) / n - 1) < 0.06


def test_states_of_different_origins_do_not_merge(spark):
    df = spark.range(1, 500).select(F.lit(1).alias("g"), "id")
    own = S.sealed(S.native(df, ["g"], "id", 12), ["g"], family="combined", k=12)
    a = own.select("g", S.tagged(F.col("state"), "s", family="combined", k=12, origin="native"))
    b = own.select("g", S.tagged(F.col("state"), "s", family="combined", k=12, origin="sketch"))
    with pytest.raises(TypeError):
        S.merge_states(a, b, ["g"], "s")
    assert abs(S.merge_states(a, a, ["g"], "s").first().estimate / 499 - 1) < 0.05
    assert S.merge_states(a, b, ["g"], "s", unsafe=True).count() == 1


def test_merged_estimate_never_fails(spark):
    df = spark.range(1000).agg(F.base64(F.hll_sketch_agg("id", F.lit(12))).alias("s"))
    row = df.select(S.merged_estimate(F.concat_ws(",", "s", "s")).alias("a"), S.merged_estimate(F.lit("")).alias("b"), S.merged_estimate(F.lit("!")).alias("c")).first()
    assert abs(row.a / 1000 - 1) < 0.05 and (row.b, row.c) == (0.0, -1.0)


def test_theta_states_keep_the_entries(spark):
    df = spark.range(3000).agg(F.theta_sketch_agg("id", F.lit(12)).alias("s"))
    row = df.select(S.theta_state("s").alias("t"), "s").first()
    plain = R.theta_uncompressed(row.s)
    head = R.theta_preamble(plain)
    assert head["retained"] == 3000 and head["seed_hash"] == 37836
    assert row.t.endswith(plain)
    assert spark.createDataFrame([(plain,)], "t binary").select(F.theta_sketch_estimate("t")).first()[0] == 3000


def test_replay_weights(spark):
    for n, m in ((0, 0), (1, 1), (999, 999), (1001, 1000), (40000, 1000)):
        got = spark.range(1).select(Q.replay_weights(F.lit(n))).first()[0]
        assert len(got) == m and sum(got) == n and (not m or max(got) - min(got) <= 1)


def test_aggregating_table(spark, tmp_path):
    table = AggregatingTable(spark, f"file://{tmp_path}/t", ["g"], {"n": "sum", "s": "theta"})
    part = lambda a, b: spark.range(a, b).groupBy((F.col("id") % 2).alias("g")).agg(F.count("*").alias("n"), F.theta_sketch_agg("id", F.lit(14)).alias("s"))
    table.append(part(0, 2000), "a")
    table.append(part(1000, 3000), "b")
    table.append(part(1000, 3000), "b")  # again: nothing happens
    read = lambda: sorted(map(tuple, table.merged().select("g", "n", F.theta_sketch_estimate("s")).collect()))
    before = read()
    assert before == [(0, 2000, 1500), (1, 2000, 1500)] and table.parts().count() == 4
    table.compact()
    assert table.parts().count() == 2 and read() == before
    table.append(part(1000, 3000), "b")  # again, after the compaction
    assert read() == before
    table.clean()
    table.append(part(0, 2000), "a")
    assert read() == before and table._parts() == []


def test_append_beside_a_compaction(spark, tmp_path):
    """A part that is appended while a compaction runs is neither lost nor counted twice."""
    table = AggregatingTable(spark, f"file://{tmp_path}/t", ["g"], {"n": "sum"})
    one = spark.createDataFrame([(None, 1), (1, 2)], "g int, n bigint")
    table.append(one, "a/1")
    table.append(one, "b")
    written, late = table._ordered, []

    def slow(df):
        if not late:
            late.append(True)
            table.append(one, "c")
        return written(df)

    table._ordered = slow
    table.compact()
    table._ordered = written
    assert sorted(map(str, map(tuple, table.merged().collect()))) == ["(1, 6)", "(None, 3)"]
    table.compact()
    assert sorted(map(str, map(tuple, table.merged().collect()))) == ["(1, 6)", "(None, 3)"] and table.parts().count() == 2
    assert AggregatingTable(spark, f"file://{tmp_path}/t", ["g"], {"n": "sum"}).merged([]).first().n == 9
    with pytest.raises(ValueError):
        AggregatingTable(spark, f"file://{tmp_path}/u", ["g"], {"n": "median"})


def test_states_in_a_table(spark, tmp_path):
    """Registers, digests and classic sketches merge across parts and survive a compaction unchanged."""
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", F.col("id").cast("double").alias("v"))
    parts = []
    for lo in (0, 1000):
        own = df.filter(f"id >= {lo} AND id < {lo} + 2000")
        h = S.sealed(S.native(own, ["g"], "id", 12), ["g"], family="hll12", k=12).withColumnRenamed("state", "h")
        d = Q.digests(own, ["g"], "v", None).withColumnRenamed("state", "d")
        c = Q.classic(own, ["g"], "v", 64).withColumnRenamed("state", "c")
        parts.append(h.join(d, "g").join(c, "g"))
    table = AggregatingTable(spark, f"file://{tmp_path}/t", ["g"], {"h": "hll12", "d": "digest", "c": "classic"})
    for i, p in enumerate(parts):
        table.append(p, f"p{i}")
    read = lambda: table.merged().select("g", S.finalised(F.col("h"), family="hll12").alias("h"), Q.digest_quantile(F.col("d"), 0.5).alias("d"), Q.sketch_info(F.col("c")).alias("c")).orderBy("g").collect()
    before = read()
    table.compact()
    after = read()
    assert [r.h for r in before] == [r.h for r in after] and [r.d for r in before] == [r.d for r in after]
    for r in before:
        assert abs(r.h / 1500 - 1) < 0.06 and abs(r.d - 1500) < 60 and (r.c.n, r.c.k, r.c.family) == (2000, 64, "classic")


@pytest.mark.parametrize("lg_k", [10, 12, 14])
@pytest.mark.parametrize("n", [0, 3, 60, 4000, 60000])
def test_estimates_and_bounds_against_the_library(spark, lg_k, n):
    hll = spark._jvm.org.apache.datasketches.hll
    a, b, both = hll.HllSketch(lg_k, hll.TgtHllType.HLL_6), hll.HllSketch(lg_k, hll.TgtHllType.HLL_8), hll.Union(lg_k)
    for i in range(n):
        a.update(i)
        b.update(i + n // 2)
    both.update(a)
    both.update(b)
    own = bytes(a.toCompactByteArray())
    assert math.isclose(E.estimate(own), a.getEstimate(), rel_tol=1e-9)
    for deviations in (1, 2):
        low, high = E.bounds(own, deviations)
        assert math.isclose(low, a.getLowerBound(deviations), rel_tol=1e-6) and math.isclose(high, a.getUpperBound(deviations), rel_tol=1e-6)
    united = bytes(both.getResult(hll.TgtHllType.HLL_8).toCompactByteArray())
    assert math.isclose(E.estimate(united), both.getEstimate(), rel_tol=0.004)
    assert f"  Log Config K   : {lg_k}" in E.summary(own)
    assert E.estimate(S.empty_sketch(lg_k)) == 0


def test_classic_sketches_against_the_library(spark):
    """Bytes of ours are read by the published library; its bytes and KLL's are read by us."""
    quantiles, memory = spark._jvm.org.apache.datasketches.quantiles, spark._jvm.org.apache.datasketches.memory.Memory
    rng = np.random.default_rng(4)
    for n in (0, 1, 100, 512, 513, 30000):
        values = rng.normal(size=n)
        state = QB.Classic(256).update(values).tobytes()
        theirs = quantiles.DoublesSketch.heapify(memory.wrap(bytearray(state)))
        assert theirs.getN() == n and theirs.getK() == 256
        weights = QB.sample(state)[1]
        assert weights.sum() == n
        if n:
            assert abs((values < theirs.getQuantile(0.5)).mean() - 0.5) < 0.02 + 1 / n
            assert QB.Classic.open(state).tobytes() == state
        sketch = quantiles.DoublesSketch.builder().setK(128).build()
        for v in values.tolist():
            sketch.update(v)
        read = QB.sample(bytes(sketch.compact().toByteArray(True)))
        assert read[1].sum() == n and (not n or abs((values < QB.quantiles(read, np.array([0.5]))[0]).mean() - 0.5) < 0.03 + 1 / n)


@pytest.mark.parametrize("n", [0, 1, 2, 17, 200, 999, 1000, 1001, 40000])
def test_replay_of_sketches(spark, n):
    state = spark.range(n).agg(F.kll_sketch_agg_double(F.col("id").cast("double"), F.lit(200)).alias("s")).first().s
    of = QB.sample(bytes(state))
    assert of[1].sum() == n
    values, weights = QB.replay(of, 1000)
    assert len(values) == min(n, 1000) and weights.sum() == n
    if 0 < n <= 200:
        assert values.tolist() == list(range(n)) and QB.rank(of, n - 1) == (n - 1) / n and QB.rank(of, n - 1, True) == 1
    if n > 200:
        order = np.cumsum(weights) / n
        for p in (0.1, 0.5, 0.99):
            assert abs(values[np.searchsorted(order, p)] / n - p) < 0.05
    with pytest.raises(ValueError):
        QB.info(b"\x01" * 8)


def test_digests():
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=20000), np.full(5000, 0.25), rng.exponential(50, 3000)])
    whole = QB.digest(values, np.ones(len(values)))
    parts = [QB.seal(QB.digest(p, np.ones(len(p)))) for p in np.array_split(values, 7)]
    merged = QB.unseal(Q.merge_digests(parts))
    for of in (whole, merged):
        assert len(of[0]) <= 1001 and of[1].sum() == len(values)
        for p in (0.001, 0.1, 0.5, 0.9, 0.999):
            got = QB.digest_quantile(of, p)
            assert (values < got).mean() - 0.01 < p < (values <= got).mean() + 0.01
    assert math.isnan(QB.digest_quantile(QB.digest(np.zeros(0), np.zeros(0)), 0.5))
    with pytest.raises(ValueError):
        QB.unseal(b"WDG1\x01\0\0\0")


def test_small_parts_of_states(spark):
    """Histograms, headers, containers, validating casts and K by column."""
    values = np.arange(4096) % 22
    histogram, zeros = R.hll12_histogram(R.encode_hll12(values))
    assert histogram.tolist() == np.bincount(values).tolist() and zeros == histogram[0]
    df = spark.range(5000).select(F.lit(1).alias("g"), "id").groupBy("g").agg(F.hll_sketch_agg("id", F.lit(14)).alias("a"), F.hll_sketch_agg(F.when(F.col("id") < 3, F.col("id")), F.lit(12)).alias("b"))
    row = df.select(S.sketch_fields(F.col("b")).alias("f"), S.hll_mode("b").alias("m"), S.container(S.combined_state(F.col("a"), 14)).alias("c")).first()
    assert (row.f.lg_k, row.f.type, row.m, row.c) == (12, "HLL_8", "LIST", "large")
    assert S.column_ks(df, ["a", "b"]) == {"a": 14, "b": 12}
    good = df.select(S.checked_cast(S.combined_state(F.col("a"), 14), family="combined", k=14).alias("s"))
    assert len(good.first().s) == R.layout(14)["size"]
    with pytest.raises(Exception, match="not a combined state"):
        df.select(S.checked_cast(F.col("a"), family="combined", k=14)).collect()
    small = b"\0\x02" + (7).to_bytes(8, "little") + (9).to_bytes(8, "little")
    assert spark.createDataFrame([(small,)], "s binary").select(S.finalised(F.col("s"), family="hll12")).first()[0] == 2
    assert R.container(bytes([2])) == "medium" and R.container(b"") == "unknown"


def test_remote_rows(spark, tmp_path):
    """Queries that an HTTP endpoint answers: ad hoc and named ones, header rows, joins, and errors as rows."""
    import http.server
    import json
    import threading

    class Answers(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            query = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["query"]
            self.answer([["n", "half"], *[[i, i / 2] for i in range(int(query.split()[-1]))]] if query != "bad" else None)

        def do_GET(self):
            self.answer([{"n": 7, "half": 3.5, "more": True}])

        def answer(self, rows):
            self.send_response(200 if rows is not None else 500)
            self.end_headers()
            for r in rows or []:
                self.wfile.write((json.dumps(r) + "\n").encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/sql"
        asked = remote.answered(spark, "SELECT 3;;SELECT 2", "n bigint, half double", url=url, header="true")
        assert sorted(map(tuple, asked.collect())) == [(0, 0.0), (0, 0.0), (1, 0.5), (1, 0.5), (2, 1.0)]
        named = remote.answered(spark, "seven", "half double, n bigint", url=url, named="true")
        assert [tuple(r) for r in named.join(spark.range(10).toDF("n"), "n").collect()] == [(7, 3.5)]
        failed = remote.answered(spark, "bad;;SELECT 1", "n bigint, error string", url=url, header="true", onError="row")
        assert sorted((r.n is None, "500" in (r.error or "")) for r in failed.collect()) == [(False, False), (True, True)]
        with pytest.raises(Exception, match="500"):
            remote.answered(spark, "bad", "n bigint", url=url).collect()
    finally:
        server.shutdown()


def test_row_binary_files(spark, tmp_path):
    remote.register(spark)
    rows = spark.range(100).select(B.rb_row(B.rb_string(F.col("id").cast("string")), B.rb_int64(F.col("id"))).alias("row"))
    for mode in ("append", "overwrite"):
        rows.repartition(3).write.format("aggstate_rowbinary").mode(mode).save(f"file://{tmp_path}/out")
        data = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("*.rowbinary"))
        at, found = 0, []
        while at < len(data):
            n = data[at]
            found.append((data[at + 1 : at + 1 + n].decode(), int.from_bytes(data[at + 1 + n : at + 9 + n], "little")))
            at += 9 + n
        assert sorted(found) == sorted((str(i), i) for i in range(100))


def test_tables_by_name(spark, tmp_path):
    catalog.create(spark, "aggstate_staging", "k int, v string", replace=True)
    catalog.create(spark, "aggstate_target", "k int, n bigint", replace=True)
    try:
        catalog.fill(spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "v string, k int"), "aggstate_staging", batch_rows=2)
        catalog.create(spark, "aggstate_staging", "other int")  # is there already
        catalog.fill_from(spark, "aggstate_staging", "aggstate_target", "SELECT k, count(*) AS n FROM aggstate_staging GROUP BY k HAVING k < :most", most=9)
        assert sorted(map(tuple, spark.table("aggstate_target").collect())) == [(1, 2), (2, 1)]
        assert not spark.catalog.tableExists("aggstate_staging")
        assert [tuple(r) for r in catalog.columns(spark.table("aggstate_target")).orderBy("place").collect()] == [(0, "k", "int"), (1, "n", "bigint")]
        assert catalog.parts(spark.table("aggstate_target")).agg(F.sum("rows")).first()[0] == 2
        assert catalog.known_functions(spark, ["hll_sketch_agg", "no_such_function"]) == {"hll_sketch_agg": True, "no_such_function": False}
        assert catalog.first_row(spark.range(1)).id == 0
        with pytest.raises(ValueError):
            catalog.first_row(spark.range(0))
    finally:
        catalog.drop(spark, "aggstate_staging")
        catalog.drop(spark, "aggstate_target")


def test_late_rows_are_dropped(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "a", 1), ("2024-01-01 05:00:00", "a", 2), ("2024-01-01 06:00:00", "a", 5), ("2024-01-01 00:20:00", "a", 3), ("2024-01-01 09:00:00", "a", 4)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "t string, c string, u bigint").coalesce(1).write.parquet(f"{tmp_path}/in/p={i}")
        os.utime(next((tmp_path / "in" / f"p={i}").glob("*.parquet")), (1e9 + i, 1e9 + i))
    stream = spark.readStream.schema("t string, c string, u bigint, p int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = views.windowed(stream, time="t", late="1 hour", window="1 hour", dims=("c",), user="u")
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sorted((str(r.ts), r.events, r.users) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(f"2024-01-01 0{h}:00:00", 1, 1) for h in (0, 5, 6)]


def test_streaming_view(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/in")
    table = AggregatingTable(spark, f"file://{tmp_path}/t", ["g"], {"n": "sum"})
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    views.materialise(stream, table, lambda b: b.groupBy((F.col("id") % 3).alias("g")).agg(F.count("*").alias("n")), f"{tmp_path}/c").awaitTermination()
    assert table.parts().count() > 3
    assert sorted(map(tuple, table.merged().collect())) == [(0, 34), (1, 33), (2, 33)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('["x", "y"]\n["1", null]\n')
    assert [tuple(r) for r in connect.json_arrays(spark, str(tmp_path / "a.json"), ["x", "y"]).collect()] == [("1", None)]
    (tmp_path / "b.json").write_text('["x", "y"]\n["x", "y"]\n\n["2", "z"]\n')  # a row like the header is data
    assert [tuple(r) for r in connect.json_arrays(spark, str(tmp_path / "b.json"), ["x", "y"]).collect()] == [("x", "y"), ("2", "z")]
    (tmp_path / "o.json").write_text('{"x": 1, "more": 2}\n{"x": null}\n')
    assert [r.x for r in connect.json_rows(spark, str(tmp_path), "x int", "o.json").collect()] == [1, None]
    connect.register_views(spark, SF, ["nation"])
    assert spark.sql("SELECT count(*) FROM nation").first()[0] == 25
    assert [connect.extract_query(x) for x in ('{"sql": "SELECT 2"}', "SELECT '\\\\t'\\n\tx")] == ["SELECT 2", "SELECT '\\t'"]
    odd = spark.createDataFrame([("a\tb\\n", None), ("\\", "x\r\ny"), ("\\\\t\n", "")], "a string, b string")
    connect.write_tsv(B.tsv_row(F.col("a"), F.col("b")), odd, f"{tmp_path}/tsv")
    assert sorted(map(str, connect.tsv_rows(spark, f"{tmp_path}/tsv", "a string, b string").collect())) == sorted(map(str, odd.collect()))
    for line in ("SELECT 1", "SELECT 1\t7", '"SELECT 1"', '{"query": "SELECT 1"}'):
        assert connect.extract_query(line) == "SELECT 1"
    assert connect.run_query(spark, "SELECT :v AS v", v=3).first().v == 3
    assert math.isclose(R.estimate(np.zeros(4096, int)), 0.0)


@pytest.fixture(scope="session")
def many(tmp_path_factory):
    """Tables whose groups have more keys than the queries' theta sketches have entries, and their queries' rows by SQL."""
    import duckdb

    folder, con = tmp_path_factory.mktemp("many"), duckdb.connect()
    tables = {
        "events": "SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i // 400) AS ts, i % 40000 AS user_id, CASE WHEN i % 10 = 0 THEN 'view' ELSE 'click' END AS event_type, CAST(i % 97 AS DOUBLE) AS value, '{\"k\": ' || (i % 5) || '}' AS props FROM range(120000) t(i)",
        "lineitem": "SELECT CAST(hash(i) % 1000003 AS DOUBLE) AS l_extendedprice, i % 2600000 AS l_partkey, CASE WHEN i % 3 = 0 THEN 'R' ELSE 'N' END AS l_returnflag, CAST(i % 50 AS DOUBLE) AS l_quantity, CASE WHEN i % 100 = 0 THEN 'O' ELSE 'F' END AS l_linestatus FROM range(4000000) t(i)",
        "customer": "SELECT i AS c_custkey FROM range(800000) t(i)",
    }
    for name, sql in tables.items():
        con.sql(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


def _as_sql(spark, many, name):
    import __spark_entry__ as entry

    folder, con = many
    rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    return rows(entry.queries()[name](spark, folder).toPandas()) == rows(con.sql(entry.oracle_sql()[name]).df())


def test_rollup_day_users_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "rollup_day_users")


def test_overflowed_parts_fail(spark):
    rows = spark.range(20000).groupBy().agg(F.theta_sketch_agg("id", F.lit(12)).alias("u"))
    with pytest.raises(Exception, match="overflowed"):
        rows.select(S.theta_count("u", 12)).collect()
    assert S.theta_parts(spark.range(1000), "id", 12) == 1


def test_multi_grain_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "multi_grain")


def test_naive_sum_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "naive_sum")


def test_theta_algebra_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "theta_algebra")


def test_theta_states_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "theta_states")


def test_theta_types_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "theta_types")


def test_incremental_view_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "incremental_view")


def test_replayed_band_builds_its_sketches_once(spark, many):
    import __spark_entry__ as entry

    assert _as_sql(spark, many, "replayed_band")
    assert "kll_sketch_agg" not in entry.queries()["replayed_band"](spark, many[0])._jdf.queryExecution().toString()


def test_identity_carry_builds_its_sketches_once(spark, many):
    import __spark_entry__ as entry

    assert _as_sql(spark, many, "identity_carry")
    assert "hll_sketch_agg" not in entry.queries()["identity_carry"](spark, many[0])._jdf.queryExecution().toString()


def test_replayed_sketches_beyond_a_sketch(spark, many):
    assert _as_sql(spark, many, "replayed_sketches") and _as_sql(spark, many, "replayed_median")
    rows = spark.range(1000).groupBy().agg(F.kll_sketch_agg_double(F.col("id").cast("double"), F.lit(200)).alias("s"))
    with pytest.raises(Exception, match="all of its values"):
        Q.replay_sketches(rows, [], "s", whole=True).collect()
