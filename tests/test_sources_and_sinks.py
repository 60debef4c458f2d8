"""CSV loading, reports, export and the whole job, on files in temporary folders.

The database sink is checked up to the writer's options: no database is started.
"""

import json
import logging
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storesales.fixtures import FIXTURE_FALL, OIL_SCALE, RAW, SALES_SCALE
from storesales.plans import retail_job
from storesales.plans.clean import CLEANERS
from storesales.plans.retail_job import export_saved, run_job
from storesales.plans.warehouse import Warehouse, _written
from storesales.queries import queries
from storesales.sources import csv, shared
from storesales.sources.csv import LoadError, load_all, read_csv, read_loaded, settle_types
from storesales.sources.schemas import RAW_FILES
from storesales.sources.shared import checkpoint, concurrently, cut, new_path, scratch, shared_dir, version
from storesales.sources.sizing import size_shuffles, stored_bytes
from storesales.sources.sinks import (
    export_all,
    jdbc_column_types,
    jdbc_options,
    jdbc_replace,
    parquet_sink,
    staged,
    swap_statements,
    write_report,
)

SF_DIR = "/root/testdata/sf0.001"

FILES = {
    "train.csv": "id,date,store_nbr,family,sales,onpromotion\n1,2015-01-01,1,\"BREAD, FRESH\",2.5,0\n2,2015-01-02,2,EGGS,,1\n",
    "stores.csv": "store_nbr,city,state,type,cluster\n1,Q,P,A,1\n2,\"\",P,B,2\n",
    "transactions.csv": "date,store_nbr,transactions\n2015-01-01,1,10\n",
    "oil.csv": "date,dcoilwtico\n2015-01-01,\n2015-01-02,52.5\n",
    "holidays_events.csv": "date,type,locale,locale_name,description,transferred\n2015-01-01,Holiday,National,E,New \"\"Year,False\n",
}


def put(folder, **changes):
    for file, text in {**FILES, **changes}.items():
        if text is not None:
            (folder / file).write_text(text)
    return str(folder)


def load(spark, folder, name):
    return settle_types(read_csv(spark, name, f"{folder}/{RAW_FILES[name]}"), name)


def test_load_types_and_values(spark, tmp_path):
    source = put(tmp_path)
    loaded = load_all(spark, source, f"{source}/out")
    assert loaded["train"].dtypes == [
        ("id", "bigint"), ("date", "date"), ("store_nbr", "int"), ("family", "string"), ("sales", "double"), ("onpromotion", "int"),
    ]
    assert [r["family"] for r in loaded["train"].orderBy("id").collect()] == ["BREAD, FRESH", "EGGS"]
    assert loaded["stores"].where("city IS NULL").count() == 1
    assert dict(loaded["holidays"].dtypes)["transferred"] == "boolean"


def test_all_failures_are_named_and_nothing_is_written(spark, tmp_path):
    source = put(tmp_path, **{"oil.csv": None, "stores.csv": "store_nbr,town,state,type,cluster\n1,Q,P,A,1\n"})
    with pytest.raises(LoadError) as error:
        load_all(spark, source, f"{source}/out")
    assert set(error.value.failures) == {"oil", "stores"}
    assert "not found" in error.value.failures["oil"] and "city" in error.value.failures["stores"]
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("crash", ["before", "after"])
def test_a_load_that_dies_leaves_all_old_or_all_new_tables(spark, tmp_path, monkeypatch, crash):
    source = put(tmp_path)
    out = f"{source}/out"
    with pytest.raises(FileNotFoundError, match="nothing was loaded"):
        read_loaded(spark, out)
    load_all(spark, source, out)
    newer = {file: text + text.splitlines()[-1] + "\n" for file, text in FILES.items()}
    put(tmp_path, **newer)
    rename = shared._replace

    def dies(*args):
        if crash == "after":
            rename(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(shared, "_replace", dies)
    with pytest.raises(KeyboardInterrupt):
        load_all(spark, source, out)
    extra = 1 if crash == "after" else 0
    rows = {"train": 2, "stores": 2, "transactions": 1, "oil": 2, "holidays": 1}
    assert {name: df.count() for name, df in read_loaded(spark, out).items()} == {n: k + extra for n, k in rows.items()}
    monkeypatch.setattr(shared, "_replace", rename)
    loaded = load_all(spark, source, out)
    assert {name: df.count() for name, df in loaded.items()} == {n: k + 1 for n, k in rows.items()}


def test_old_loads_are_removed_but_the_last(spark, tmp_path):
    source = put(tmp_path)
    first = load_all(spark, source, f"{source}/out/raw")
    for _ in range(2):
        assert first["oil"].count() == 2  # still there for who has begun to read
        second, first = first, load_all(spark, source, f"{source}/out/raw")
    folders = sorted(p.name for p in (tmp_path / "out" / "raw").glob("load-*"))
    assert len(folders) == 2 and second["oil"].count() == 2


def test_columns_are_bound_by_name_and_extra_ones_pass(spark, tmp_path):
    source = put(tmp_path, **{"oil.csv": "dcoilwtico,note,n,date\n50.5,hello,7,2015-01-01\n"})
    df = load(spark, source, "oil")
    assert dict(df.dtypes) == {"dcoilwtico": "double", "note": "string", "n": "bigint", "date": "date"}
    assert df.first().asDict()["dcoilwtico"] == 50.5


def test_values_of_the_wrong_type_stay_visible(spark, tmp_path):
    text = "date,store_nbr,transactions\n2015-01-01,1.0,10\nsoon,2.0,many\n"
    df = load(spark, put(tmp_path, **{"transactions.csv": text}), "transactions")
    assert dict(df.dtypes) == {"date": "string", "store_nbr": "double", "transactions": "string"}
    cleaned = {r["store_nbr"]: r["transactions"] for r in CLEANERS["transactions"].stage(df).collect()}
    assert cleaned == {1: 10, 2: None}


def test_short_records_end_in_nulls_and_long_ones_fail(spark, tmp_path):
    short = put(tmp_path, **{"oil.csv": "date,dcoilwtico\n2015-01-01\n2015-01-02,5\n"})
    assert load(spark, short, "oil").where("dcoilwtico IS NULL").count() == 1
    long = put(tmp_path, **{"oil.csv": "date,dcoilwtico\n2015-01-01,4,5\n"})
    with pytest.raises(ValueError, match="too many fields"):
        load(spark, long, "oil")
    text_columns = put(tmp_path, **{"stores.csv": "store_nbr,city,state,type,cluster\n1,a,b,c,4,5\n"})
    with pytest.raises(ValueError, match="too many fields"):
        load(spark, text_columns, "stores")
    quoted = put(tmp_path, **{"stores.csv": 'store_nbr,city,state,type,cluster\n1,"a,b,c,d",P\n'})
    assert load(spark, quoted, "stores").first()["city"] == "a,b,c,d"


def test_line_breaks_inside_quotes_are_found_or_read(spark, tmp_path):
    for text in ('"a\nb",P,A,1', '"Q",P,A,"1\n2"'):
        source = put(tmp_path, **{"stores.csv": f"store_nbr,city,state,type,cluster\n1,{text}\n"})
        with pytest.raises(ValueError, match="open quote"):
            load(spark, source, "stores")
        whole = settle_types(read_csv(spark, "stores", f"{source}/stores.csv", multi_line=True), "stores")
        assert whole.count() == 1


def test_header_only_and_byte_order_mark(spark, tmp_path):
    df = load(spark, put(tmp_path, **{"oil.csv": "﻿date,dcoilwtico\n"}), "oil")
    assert df.dtypes == [("date", "date"), ("dcoilwtico", "double")] and df.count() == 0


def test_checkpoint_replaces_and_partitions(spark, tmp_path):
    df = spark.range(4).withColumn("anio", F.col("id") % 2)
    path = str(tmp_path / "t")
    checkpoint(df, path, ("anio",))
    again = checkpoint(df.limit(3), path, ("anio",))
    assert again.count() == 3 and (tmp_path / "t" / "anio=0").exists()
    assert cut(df, "x").count() == 4


def test_a_table_is_replaced_from_its_staging_table_in_one_transaction(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).repartition(4).write.parquet(path)
    rows = staged(spark.read.parquet(path))
    # The same numbers however often a task reads its part of the written table.
    again = rows.unionByName(staged(spark.read.parquet(path)))
    assert rows.select("__row").distinct().count() == 20 and again.distinct().count() == 20
    statements = swap_statements("public.eda", "public.eda_ab", ["n", "mes"])
    assert statements == [
        'CREATE TABLE public.eda_ab_whole AS SELECT "n", "mes" FROM (SELECT DISTINCT * FROM public.eda_ab) AS loaded',
        "DROP TABLE public.eda_ab",
        "DROP TABLE IF EXISTS public.eda",
        "ALTER TABLE public.eda_ab_whole RENAME TO eda",
    ]


def test_a_failed_database_load_drops_its_staging_table_only(spark):
    ran = []
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_replace(spark.range(1), "eda", "jdbc:nothing:x", run=ran.extend)
    (statement,) = ran
    assert re.fullmatch(r"DROP TABLE IF EXISTS eda_[0-9a-f]{12}", statement)


def test_report_keeps_nulls(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b, named_struct('c', array(1, 2)) AS d")
    write_report(df, str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("*.json")
    assert json.loads(part.read_text()) == {"a": 1, "b": None, "d": {"c": [1, 2]}}


def test_database_types_and_options(spark):
    schema = T.StructType.fromDDL(
        "mes tinyint, n int, big bigint, x float, y double, z decimal(10,2), ok boolean, d date, t timestamp, s string"
    )
    assert jdbc_column_types(schema) == (
        "`mes` BIGINT, `n` BIGINT, `big` BIGINT, `x` DOUBLE, `y` DOUBLE, `z` DOUBLE, "
        "`ok` BOOLEAN, `d` DATE, `t` TIMESTAMP, `s` STRING"
    )
    options = jdbc_options(spark.range(1), "t", "jdbc:x", 4)
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": 100_000, "numPartitions": 4, "createTableColumnTypes": "`id` BIGINT",
    }
    staging = staged(spark.range(3))
    assert jdbc_options(staging, "t", "jdbc:x", 4)["createTableColumnTypes"] == "`id` BIGINT, `__row` BIGINT"
    # Spark must be able to read the types it is given.
    assert len(T.StructType.fromDDL(jdbc_column_types(schema)).fields) == 10


def test_export_warns_about_what_is_absent(spark, caplog):
    sent = []
    with caplog.at_level(logging.WARNING):
        names = export_all(lambda df, name: sent.append(name), spark.range(1))
    assert names == sent == ["ventas_consolidado"]
    assert len(caplog.records) == 3


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """The whole job on the test tables as CSV files."""
    folder = tmp_path_factory.mktemp("job")
    for name, file in RAW_FILES.items():
        RAW[name](spark, SF_DIR).write.csv(f"{folder}/in/{file}", header=True)
    result = run_job(
        spark, f"{folder}/in", f"{folder}/out", parquet_sink(f"{folder}/db"), SALES_SCALE, OIL_SCALE, FIXTURE_FALL
    )
    return result, folder


JOB_TABLES = {
    "ventas_por_familia": "sales_by_family",
    "ventas_por_tienda": "sales_by_store",
    "ventas_promedio_por_ciudad": "avg_sales_by_city",
    "ventas_promedio_por_provincia": "avg_sales_by_state",
    "evolucion_ventas_mensual": "sales_monthly",
    "evolucion_ventas_anual": "sales_yearly",
    "ventas_feriado_vs_normal": "holiday_vs_normal",
    "ventas_alrededor_feriados_por_familia": "sales_around_holidays",
    "sensibilidad_familias_feriados": "holiday_sensitivity",
    "ventas_con_sin_promocion_por_familia": "sales_promo_split",
    "efecto_promocion_por_familia": "promo_effect",
    "ventas_vs_petroleo_mensual": "sales_vs_oil_monthly",
    "ventas_ciudad_periodo_petroleo": "sales_city_period",
    "sensibilidad_ciudades_petroleo": "city_period_sensitivity",
    "ticket_promedio_por_tienda": "avg_ticket_by_store",
}


def test_job_tables_equal_the_queries(spark, job):
    result, _ = job
    assert set(result.tables) == set(JOB_TABLES)
    known = queries()
    for table, query in JOB_TABLES.items():
        found = sorted(map(str, result.tables[table].collect()))
        assert found == sorted(map(str, known[query](spark, SF_DIR).collect())), table


def test_job_reports_equal_the_queries(spark, job):
    result, _ = job
    for frame, query in ((result.quality, "profile_tables"), (result.metrics, "cleaning_metrics")):
        assert sorted(map(str, frame.collect())) == sorted(map(str, queries()[query](spark, SF_DIR).collect()))


def test_job_exports_eighteen_tables(spark, job):
    result, folder = job
    names = sorted(p.name for p in (folder / "db").iterdir())
    assert len(names) == 18
    assert {"ventas_consolidado", "calidad_datos_inicial", "metricas_limpieza", "eda_ventas_por_familia"} <= set(names)
    exported = spark.read.parquet(f"{folder}/db/ventas_consolidado")
    assert len(exported.columns) == 17
    assert exported.count() == result.cleaned["train"].count()


def test_an_earlier_run_can_be_exported_again(spark, job, tmp_path, caplog):
    result, folder = job
    sent = {}
    names = export_saved(spark, f"{folder}/out", lambda df, name: sent.update({name: df}))
    assert len(names) == 18 and set(names) == set(sent)
    assert sent["ventas_consolidado"].columns == result.consolidated.columns
    assert sent["metricas_limpieza"].count() == 5
    spark.range(3).write.parquet(f"{tmp_path}/consolidated")
    with caplog.at_level(logging.WARNING):
        assert export_saved(spark, str(tmp_path), lambda df, name: None) == ["ventas_consolidado"]
    assert len(caplog.records) == 3


def read_report(folder, name):
    (part,) = (folder / "out" / "reports" / name).glob("*.json")
    return json.loads(part.read_text())


def test_job_json_reports(spark, job):
    result, folder = job
    profile = read_report(folder, "eda_inicial")
    assert profile["etapa"] == "eda_inicial (antes de limpiar)" and profile["generado_en"].endswith("+00:00")
    assert list(profile["archivos"]) == list(RAW_FILES)
    train = profile["archivos"]["train"]
    assert (train["filas"], train["filas_duplicadas"], train["columnas"]) == (6120, 120, 6)
    assert train["columnas_detalle"]["sales"]["tipo"] == "double"
    assert profile["archivos"]["stores"]["rango_fechas"] is None
    assert read_report(folder, "metricas_limpieza")["train"]["duplicados_removidos"] == 120
    summary = read_report(folder, "eda_profundo")
    assert list(summary) == [
        "familia_mayor_volumen", "top_10_tiendas", "bottom_10_tiendas", "impacto_feriados",
        "familias_mas_sensibles_a_feriados", "familias_con_mayor_efecto_promocion", "correlacion_petroleo_ventas",
        "correlacion_lag_petroleo_1997_1998", "ciudades_mas_sensibles_caida_petroleo",
        "correlacion_transacciones_ventas", "tiendas_ticket_alto", "tiendas_ticket_bajo",
    ]
    stores = [r.asDict() for r in result.tables["ventas_por_tienda"].orderBy(F.desc("ventas_totales"), "store_nbr").collect()]
    assert summary["top_10_tiendas"] == stores[:10] and summary["bottom_10_tiendas"] == stores[-10:]
    assert summary["familia_mayor_volumen"]["family"] == queries()["top_family"](spark, SF_DIR).first()["family"]
    assert set(summary["correlacion_lag_petroleo_1997_1998"]) == {"lag_1_meses", "lag_2_meses", "lag_3_meses"}


def test_part_files_with_other_headers_are_refused(spark, tmp_path):
    source = put(tmp_path, **{"stores.csv": None})
    folder = tmp_path / "stores.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("store_nbr,city,state,type,cluster\n1,a,b,c,4\n")
    (folder / "b.csv").write_text("store_nbr,city,state,type,cluster\n2,a,b,c,4\n")
    assert load_all(spark, source, f"{source}/out")["stores"].count() == 2
    (folder / "b.csv").write_text("store_nbr,state,city,type,cluster\n2,b,a,c,4\n")
    with pytest.raises(LoadError) as error:
        load_all(spark, source, f"{source}/again")
    assert set(error.value.failures) == {"stores"} and not (tmp_path / "again").exists()


def test_a_missing_folder_names_all_tables(spark, tmp_path):
    with pytest.raises(LoadError) as error:
        run_job(spark, f"{tmp_path}/nowhere", f"{tmp_path}/out")
    assert set(error.value.failures) == set(RAW_FILES)


def test_csv_is_parsed_again_only_for_values_that_do_not_fit(spark, tmp_path, monkeypatch):
    again = []
    monkeypatch.setattr(csv, "settle_types", lambda text, name, settle=csv.settle_types: again.append(name) or settle(text, name))
    source = put(tmp_path)
    load_all(spark, source, f"{source}/out")
    assert again == []
    source = put(tmp_path, **{"transactions.csv": "date,store_nbr,transactions\nsoon,1,2\n"})
    found = load_all(spark, source, f"{source}/out")["transactions"]
    assert again == ["transactions"] and found.first()["date"] == "soon"


def test_the_profile_is_there_when_cleaning_fails(spark, tmp_path, monkeypatch):
    def fail(raw, out):
        raise RuntimeError("cleaning")

    monkeypatch.setattr(retail_job, "clean_stage", fail)
    source = put(tmp_path)
    with pytest.raises(RuntimeError, match="cleaning"):
        run_job(spark, source, f"{source}/out")
    assert spark.read.parquet(f"{source}/out/reports/calidad_datos_inicial").count() == 5
    assert list((tmp_path / "out" / "reports" / "eda_inicial").glob("*.json"))


def test_job_warns_when_joins_multiply(spark, tmp_path, caplog):
    source = put(tmp_path, **{"oil.csv": "date,dcoilwtico\n2015-01-01,50\n2015-01-01,51\n2015-01-02,52.5\n"})
    with caplog.at_level(logging.WARNING):
        result = run_job(spark, source, f"{source}/out")
    assert any("from 2 to 3" in r.getMessage() for r in caplog.records)
    assert result.consolidated.count() == 3


def test_job_stops_at_the_first_failing_stage(spark, tmp_path):
    source = put(tmp_path, **{"oil.csv": None})
    with pytest.raises(LoadError):
        run_job(spark, source, f"{source}/out")
    assert not (tmp_path / "out").exists()


class FakeSession:
    """What ``shared_dir`` asks of a session."""

    def __init__(self, master, folder=None):
        self.folder = folder
        self.master = master
        self.conf = self
        self.sparkContext = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_sessions_own(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(FakeSession("yarn", "hdfs:/cp")) == "hdfs:/cp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.folder


def test_tables_are_written_again_if_the_folder_was_emptied(spark, settings):
    label = Warehouse(spark, SF_DIR).raw("oil")
    key = (spark.sparkContext.applicationId, SF_DIR, "raw-oil")
    version, path, schema = _written[key]
    _written[key] = (version, path + "-gone", schema)
    assert Warehouse(spark, SF_DIR).raw("oil").count() == label.count() == 1094
    assert _written[key][1] not in (path, path + "-gone")


def test_changed_input_is_read_again(spark, tmp_path):
    for name in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert Warehouse(spark, str(tmp_path)).raw("stores").count() == 11
    spark.read.parquet(f"{SF_DIR}/supplier.parquet").limit(4).write.mode("overwrite").parquet(f"{tmp_path}/supplier.parquet")
    assert Warehouse(spark, str(tmp_path)).raw("stores").count() < 11


def test_scratch_tables_go_with_their_scope(spark):
    with scratch(spark):
        inside = new_path(spark, "inside")
        concurrently(spark, lambda i: cut(spark.range(3), f"t{i}"), [1, 2])
        checkpoint(spark.range(3), inside)
        assert spark.read.parquet(inside).count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(inside)
    checkpoint(spark.range(3), outside := new_path(spark, "outside"))
    assert version(spark, outside) and not version(spark, inside)


def test_shuffles_follow_the_input(spark, settings, tmp_path):
    settings({"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "5"})
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x" * 1000)
    (tmp_path / "in" / "b.csv").write_text("x" * 500)
    source = [spark.read.text(str(tmp_path / "in"))]
    assert stored_bytes(source) == 1500
    assert size_shuffles(spark, source, 10) == 5
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert size_shuffles(spark, source, 1500) == 8
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert size_shuffles(spark, source, 1) == 1500
    settings({"storesales.shuffle.mostPartitions": "100"})
    assert size_shuffles(spark, source, 1) == 100
    assert size_shuffles(spark, source, 1500) == 8
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert size_shuffles(spark, source, 15) == 100
    grouped = spark.range(9).groupBy(F.col("id") % 3).count()
    assert ", 100)" in grouped._jdf.queryExecution().executedPlan().toString()


def test_tasks_read_little_at_once_unless_the_user_says_otherwise(spark, settings):
    scan, shuffle = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings({scan: "1m", shuffle: "5m"})
    spark.conf.unset(scan)
    Warehouse(spark, SF_DIR)
    assert (spark.conf.get(scan), spark.conf.get(shuffle)) == (str(16 << 20), "5m")
    spark.conf.unset(shuffle)
    Warehouse(spark, SF_DIR)
    assert (spark.conf.get(scan), spark.conf.get(shuffle)) == (str(16 << 20), str(32 << 20))


def test_tables_without_rows_are_loaded(spark, tmp_path):
    source = put(tmp_path, **{"oil.csv": "﻿date,dcoilwtico\n", "transactions.csv": "date,store_nbr,transactions\n"})
    loaded = load_all(spark, source, f"{source}/out")
    assert loaded["oil"].count() == loaded["transactions"].count() == 0
    assert loaded["oil"].dtypes == [("date", "date"), ("dcoilwtico", "double")]
