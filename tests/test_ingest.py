"""Text functions, feed parsing, upserts, files and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quotegrid.functions import text as tx
from quotegrid.operators import upsert as up
from quotegrid.schema import column_name
from quotegrid.sources import feed
from quotegrid.sources import tables as tb
from quotegrid.streaming import ingest as ig


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn("x")).head()[0]


@pytest.mark.parametrize("raw, want", [
    ("1,659", 1.659), ("", None), ("  ", None), ("1.234,5", None), ("abc", None), ("1,5d", None), ("\t-1,25 ", -1.25), ("NaN", None), ("2e1", 20.0),
])
def test_decimal_comma(spark, raw, want):
    assert one(spark, raw, tx.decimal_comma) == want


@pytest.mark.parametrize("raw, want", [
    ("2024-01-05", dt.date(2024, 1, 5)), ("2024-1-5", dt.date(2024, 1, 5)), ("05-01-2024", None), ("2024-02-30", None), ("x", None),
])
def test_strict_date(spark, raw, want):
    assert one(spark, raw, tx.strict_date) == want


def test_names(spark):
    assert one(spark, "  ÁLCÀntarïlla Ñ ", tx.normalized_name) == "alcantarilla n"
    assert one(spark, "Precio Gasolina 95 E5", tx.column_name) == column_name("Precio Gasolina 95 E5") == "precio_gasolina_95_e5"
    assert one(spark, "v12", tx.next_version) == "v13" and one(spark, None, tx.next_version) == "v2"


RECORD = {"IDEESS": "7", "Rótulo": " R ", "Municipio": "M", "Longitud": "2,5", "Precio Gasoleo A": "1,5", "Precio Gasoleo B": ""}


def test_both_document_shapes(spark):
    texts = [json.dumps({"ListaEESSPrecio": [RECORD, {"IDEESS": "8", "Longitud (WGS84)": "", "Longitud": "9"}], "Nota": "x"}),
             json.dumps([RECORD]), json.dumps({"ListaEESSPrecio": []}), "not json"]
    docs = spark.createDataFrame([(dt.date(2024, 1, 1), t) for t in texts], "date date, value string")
    rows = feed.parse_records(feed.raw_records(docs)).orderBy("station_id").collect()
    assert [r["station_id"] for r in rows] == ["7", "7", "8"]
    assert rows[0]["longitude"] == 2.5 and rows[0]["precio_gasoleo_a"] == 1.5 and rows[0]["precio_gasoleo_b"] is None
    assert rows[0]["station_name"] == "R" and rows[0]["address"] == ""
    assert rows[2]["longitude"] is None  # the long key is there, though empty
    assert [r[0] for r in docs.select(feed.unreadable(docs)).collect()] == [False, False, False, True]


def test_upserts(spark):
    cur = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1.0), (dt.date(2024, 1, 2), "a", 2.0)], "date date, station_id string, p double")
    batch = spark.createDataFrame([(dt.date(2024, 1, 2), "a", 5.0, 1), (dt.date(2024, 1, 2), "a", None, 2)] * 50, "date date, station_id string, p double, n int")
    once = up.upsert_prices(cur, batch, ["n"])
    twice = up.upsert_prices(once, batch, ["n"])
    want = {(dt.date(2024, 1, 1), "a", 1.0), (dt.date(2024, 1, 2), "a", None)}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want


def test_config_and_files(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"models": [{"scope_id": "s", "fuel_col": "f", "horizon_days": 3, "waiting_cost": 0.001}]}, indent=1))
    models = tb.read_production(spark, str(tmp_path / "m.json"))
    assert tb.one_row(models, scope_id="s", fuel_col="f")["horizon_days"] == 3
    with pytest.raises(KeyError):
        tb.one_row(models, scope_id="x")
    with pytest.raises(ValueError):
        tb.write_dataset(models, str(tmp_path / "out.xlsx"))
    for table in ("stations", "prices", "fetch_log"):
        assert tb.read_history(spark, str(tmp_path), table).count() == 0
    (tmp_path / "stations.csv").write_text(
        "station_id,station_name,address,municipality,province,latitude,longitude,schedule,updated_at\n"
        '2132,REPSOL,"CARRETERA KM. 0,2",A,M,37.97,,L-D,2026-03-29T05:52:30.535638\n'
    )
    row = tb.read_history(spark, str(tmp_path), "stations").head()
    assert row["address"] == "CARRETERA KM. 0,2" and row["longitude"] is None and row["updated_at"].year == 2026


def test_stream(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")

    def land(day, name, text):
        folder = landing / f"date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")

    land("2024-01-01", "a.json", json.dumps({"ListaEESSPrecio": [RECORD, {**RECORD, "Precio Gasoleo A": "1,6"}]}, indent=1))
    land("2024-01-02", "a.json", "{broken")
    land("2024-01-03", "a.json", json.dumps([]))
    ig.ingest(spark, str(landing), store)
    ig.ingest(spark, str(landing), store)
    status = {str(r["date"]): r["status"] for r in ig.current_fetch_log(spark, store).collect()}
    assert status == {"2024-01-01": "fetched", "2024-01-02": "failed", "2024-01-03": "empty"}
    assert [r["precio_gasoleo_a"] for r in ig.current_table(spark, store, "prices").collect()] == [1.6]

    land("2024-01-01", "b.json", json.dumps([{**RECORD, "Precio Gasoleo A": "9"}]))  # a processed day is skipped
    land("2024-01-02", "b.json", json.dumps([{**RECORD, "Precio Gasoleo A": "1,7"}]))  # a failed one is tried again
    ig.ingest(spark, str(landing), store)
    prices = {str(r["date"]): r["precio_gasoleo_a"] for r in ig.current_table(spark, store, "prices").collect()}
    assert prices == {"2024-01-01": 1.6, "2024-01-02": 1.7}
    land("bad-day", "a.json", json.dumps([RECORD]))
    ig.ingest(spark, str(landing), store)
    assert {(r["day"], r["reason"]) for r in ig.rejected(spark, store).collect()} == {("2024-01-02", "UnreadableDocument"), ("bad-day", "UnreadableDay")}
    merged = ig.compact(spark, store, str(tmp_path / "merged"))
    assert ig.current_table(spark, merged, "prices").count() == 2 and ig.current_fetch_log(spark, merged).count() == 3
    assert ig.current_table(spark, merged, "stations").count() == 1
    land("2024-01-04", "a.json", json.dumps([RECORD]))
    ig.ingest(spark, str(landing), merged)  # goes on where the old store was: one new day, nothing read again
    assert ig.current_table(spark, merged, "prices").count() == 3 and ig.rejected(spark, merged).count() == 2


def test_a_run_broken_off_goes_on_with_its_snapshot(spark, tmp_path):
    landing, store = tmp_path / "landing" / "date=2024-01-01", str(tmp_path / "store")
    landing.mkdir(parents=True)
    for i in range(6):
        (landing / f"{i}.json").write_text(json.dumps([{**RECORD, "IDEESS": str(i)}]), encoding="utf-8")
    run, real, calls = ig.open_run(spark, store), ig.write_batch, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    ig.write_batch = failing
    try:
        with pytest.raises(Exception):
            ig.ingest(spark, str(tmp_path / "landing"), store, files_per_batch=2)
    finally:
        ig.write_batch = real
    assert ig.open_run(spark, store) == run
    ig.ingest(spark, str(tmp_path / "landing"), store, files_per_batch=2)
    assert ig.current_table(spark, store, "prices").count() == 6
    entry = ig.current_fetch_log(spark, store).collect()
    assert [(r["status"], r["records_count"]) for r in entry] == [("fetched", 6)] and ig.open_run(spark, store) == run + 1


def test_feeds_land_in_more_files_the_larger_the_tables(spark, monkeypatch, tmp_path):
    from quotegrid import catalog

    n = spark.range(4_000)
    lines = n.selectExpr(
        "id % 40 + 1 l_suppkey", "date_add(date '2001-01-01', cast(id div 40 as int)) l_shipdate", "1000.0D + id l_extendedprice",
        "'A' l_returnflag", "cast(id % 5 + 1 as int) l_linenumber")
    tables = {
        "lineitem": lines, "supplier": spark.range(1, 41).selectExpr("id s_suppkey", "concat('s', id) s_name", "0 s_nationkey"),
        "nation": spark.sql("select 0 n_nationkey, 'N' n_name, 0 n_regionkey"), "region": spark.sql("select 0 r_regionkey, 'R' r_name")}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert catalog._more_files(spark, str(tmp_path)) == 1
    monkeypatch.setattr(catalog, "LINES_LANDED", 1_000)
    more = catalog._more_files(spark, str(tmp_path))
    assert more == 4
    landing = catalog._split_landing(spark, str(tmp_path), more)
    landed = spark.read.schema("date string, value string").json(landing).withColumn("file", F.col("_metadata.file_name"))
    sizes = [r["count"] for r in landed.groupBy("file").count().collect()]
    assert sum(sizes) == 4_000 and len(sizes) > 5 and max(sizes) < 4_000 / 5
    assert landed.groupBy("date").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n")).where("n > 5 and files = 1").count() == 0
    kept = catalog.stream_ingest(spark, str(tmp_path))
    assert kept.count() == catalog.feed_documents(spark, str(tmp_path)).count() == 4_000
