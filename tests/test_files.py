"""Files on disk: ingest, publish, and the whole build."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolake.operators import governance, quality
from aerolake.operators.publish import KeptLoads, publish, stored
from aerolake.plans import gold, pipeline
from aerolake.plans.dictionary import GLOSSARY
from aerolake.sources import layouts
from aerolake.sources.delimited import MissingColumns, read_delimited
from tests.test_plans import plan

PREAMBLE = "Atualizado em: 01/02/2026"
COLUMNS = {"Código": "codigo", "Nome": "nome", "Nota": "nota"}


def write(path, lines, encoding="utf-8", bom=False):
    text = "\n".join(lines) + "\n"
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode(encoding))
    return str(path)


def landed(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("bom", [False, True])
def test_preamble_and_header_are_not_rows(spark, tmp_path, bom):
    path = write(tmp_path / "a.csv", [PREAMBLE, "Código;Nome;Nota", "1;Um;x", "2;Dois;y"], bom=bom)
    assert landed(read_delimited(spark, path, COLUMNS)) == [("1", "Um", "x"), ("2", "Dois", "y")]


@pytest.mark.parametrize("bom", [False, True])
def test_file_without_preamble(spark, tmp_path, bom):
    path = write(tmp_path / "a.csv", ["Código;Nome;Nota", "1;Um;x"], bom=bom)
    assert landed(read_delimited(spark, path, COLUMNS)) == [("1", "Um", "x")]


def test_rows_that_look_like_a_preamble_stay(spark, tmp_path):
    path = write(tmp_path / "a.csv", [PREAMBLE, "Código;Nome;Nota", PREAMBLE, "Código;;"])
    assert landed(read_delimited(spark, path, COLUMNS)) == [
        (PREAMBLE, None, None),
        ("Código", None, None),
    ]


def test_quoting_empty_short_and_long(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        [
            PREAMBLE,
            '"Código";"Nome";"Nota"',
            '1;"A""B";z',
            '2;"x;y";z',
            '3;;""',
            "4;curta",
            "5;longa;z;sobra;mais",
        ],
    )
    assert landed(read_delimited(spark, path, COLUMNS, escape='"')) == [
        ("1", 'A"B', "z"),
        ("2", "x;y", "z"),
        ("3", None, None),
        ("4", "curta", None),
        ("5", "longa", "z"),
    ]


def test_quote_off_latin1(spark, tmp_path):
    line = "9° 52' 08\" S"
    path = write(
        tmp_path / "a.csv", [PREAMBLE, "Código;Nome;Nota", f"1;{line};São Paulo"], "iso-8859-1"
    )
    rows = read_delimited(spark, path, COLUMNS, quote=None, encoding="ISO-8859-1")
    assert landed(rows) == [("1", line, "São Paulo")]


def test_two_files_by_name_with_provenance(spark, tmp_path):
    write(tmp_path / "jan.csv", [PREAMBLE, "Código;Nome;Nota", "1;Um;x"])
    write(tmp_path / "feb.csv", [PREAMBLE, "Outra;Nota;Nome;Código", "q;y;Dois;2"], bom=True)
    rows = read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS, file_column="_arquivo_origem")
    assert landed(rows) == [("1", "Um", "x", "jan.csv"), ("2", "Dois", "y", "feb.csv")]


def test_odd_file_names(spark, tmp_path):
    for n, name in enumerate(("VRA 2025 [jan] é.csv", "a%20b.csv", "c{x}.csv")):
        write(tmp_path / name, [PREAMBLE, "Código;Nome;Nota", f"{n};Um;x"])
    rows = read_delimited(spark, str(tmp_path), COLUMNS)
    assert sorted(r["codigo"] for r in rows.collect()) == ["0", "1", "2"]


@pytest.mark.parametrize("top", [[], [PREAMBLE]])
def test_rows_that_repeat_the_header_stay(spark, tmp_path, top):
    header = "Código;Nome;Nota"
    write(tmp_path / "a.csv", [*top, header, "1;Um;x", header, "2;Dois;y", header])
    write(tmp_path / "b.csv", [*top, header, header])
    write(tmp_path / "c.csv", [*top, header])
    rows = read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS, file_column="_arquivo_origem")
    again = tuple(header.split(";"))
    assert landed(rows) == sorted(
        [("1", "Um", "x", "a.csv"), ("2", "Dois", "y", "a.csv"), *[(*again, f) for f in ("a.csv", "a.csv", "b.csv")]]
    )


def test_discovery_does_not_grow_with_the_files(spark, tmp_path):
    """A few hundred files cost as many jobs as a few, and with one layout the glob is scanned itself."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(count, odd):
        folder = tmp_path / f"{count}-{odd}"
        folder.mkdir()
        for i in range(count):
            header = "Nota;Código;Nome" if odd and i % 2 else "Código;Nome;Nota"
            write(folder / f"{i}.csv", [PREAMBLE, header, f"{i};{i};{i}"])
        group = f"discovery-{count}-{odd}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            rows = read_delimited(spark, str(folder / "*.csv"), COLUMNS)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows.count() == count
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(300, False) <= 12
    assert jobs(40, True) <= 12


@pytest.mark.parametrize("odd", [False, True])
def test_files_are_scanned_once(spark, tmp_path, odd):
    """One scan of the glob whatever the layouts, and no list of paths in the plan or the driver."""
    for i in range(60):
        header = "Nota;Código;Nome" if odd and i % 2 else "Código;Nome;Nota"
        fields = f"x;{i};Um" if odd and i % 2 else f"{i};Um;x"
        write(tmp_path / f"{i}.csv", [PREAMBLE, header, fields, header])
    rows = read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS)
    text = plan(rows)
    assert text.count("FileScan csv") == 1 and "59.csv" not in text
    assert text.count("Exchange hashpartitioning") == 0 or "InMemoryTableScan" in text
    assert len(landed(rows)) == 120
    assert landed(rows.where("nota = 'x'").select("codigo")) == sorted([(str(i),) for i in range(60)], key=str)


def test_the_first_row_of_a_file_is_told_apart_below_any_filter(spark, tmp_path):
    """A filter that drops rows ahead of a repeated header must not make it look like the first."""
    header = "Código;Nome;Nota"
    for i in range(30):
        write(tmp_path / f"{i}.csv", [PREAMBLE, header, "1;Um;x", header])
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS)
        assert rows.where("codigo <> '1'").count() == 30
        assert rows.where("nota = 'Nota'").select("nome").count() == 30
        assert rows.count() == 60
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_only_spark_can_read_the_store(spark, tmp_path, monkeypatch):
    from aerolake.sources import delimited

    write(tmp_path / "a.csv", [PREAMBLE, "Código;Nome;Nota", "1;Um;x"])
    write(tmp_path / "b.csv", ["Nota;Nome;Código", "y;Dois;2"])
    monkeypatch.setattr(delimited, "_store_of", lambda path: None)
    rows = delimited.read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS)
    assert landed(rows) == [("1", "Um", "x"), ("2", "Dois", "y")]


def test_file_larger_than_a_split(spark, tmp_path):
    """The header is dropped once, not once per split, and no row is lost at the seams."""
    rows = [f"{i};nome {i};{'x' * 50}" for i in range(20_000)]
    path = write(tmp_path / "a.csv", [PREAMBLE, "Código;Nome;Nota", *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        df = read_delimited(spark, path, COLUMNS)
        assert df.rdd.getNumPartitions() > 4
        counted = df.agg(F.count("*"), F.countDistinct("codigo"), F.max(F.length("nota"))).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(counted) == (20_000, 20_000, 50)


def test_missing_columns_are_listed(spark, tmp_path):
    write(tmp_path / "ok.csv", [PREAMBLE, "Código;Nome;Nota", "1;Um;x"])
    write(tmp_path / "bad.csv", [PREAMBLE, "Código;Apelido", "1;Um"])
    with pytest.raises(MissingColumns, match=r"bad\.csv.*Nome.*Nota"):
        read_delimited(spark, str(tmp_path / "*.csv"), COLUMNS)


# --- publish ---------------------------------------------------------------------------------


def test_refresh_replaces_rows_and_schema(spark):
    assert publish(spark.range(5), "t_refresh.a") == 5
    assert publish(spark.range(5), "t_refresh.a") == 5
    replaced = spark.range(3).withColumn("novo", F.lit("x"))
    assert publish(replaced, "t_refresh.a", {"novo": "New column."}) == 3
    table = spark.table("t_refresh.a")
    assert table.columns == ["id", "novo"]
    assert table.schema["novo"].metadata["comment"] == "New column."


def test_refresh_drops_vanished_partitions(spark, tmp_path):
    first = spark.range(10).withColumn("p", F.col("id") % 3)
    for target in ("t_refresh.b", str(tmp_path / "b")):
        assert publish(first, target, partition_by=["p"]) == 10
        assert publish(first.where("p = 1"), target, partition_by=["p"]) == 3
        assert stored(spark, target).count() == 3


def test_null_partition_round_trips(spark):
    rows = spark.createDataFrame([(1, None), (2, dt.date(2025, 1, 1))], "id int, d date")
    publish(rows, "t_refresh.c", partition_by=["d"])
    assert landed(spark.table("t_refresh.c")) == [(1, None), (2, dt.date(2025, 1, 1))]


def test_hot_partition_is_split_into_several_files(spark, tmp_path):
    """Nine rows in ten share one partition value; their files are written by several tasks."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 50).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        publish(rows, str(tmp_path / "hot"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "p=0").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 400_000


@pytest.mark.parametrize("kind", ["table", "path"])
def test_versions_are_kept_and_reloads_replace(spark, tmp_path, kind):
    target = "t_refresh.v" if kind == "table" else str(tmp_path / "v")
    def stamped(n, operation):
        rows = spark.range(n).withColumn("_ingerido_em", F.current_timestamp())
        return rows.withColumn("_operacao", F.lit(operation))

    assert publish(stamped(5, "create"), target, version=0) == 5
    assert publish(stamped(8, "load"), target, version=1) == 8
    assert publish(stamped(7, "load"), target, version=1) == 7
    rows = stored(spark, target)
    ledger = governance.load_ledger(rows, "_versao", "_ingerido_em", "_operacao").collect()
    assert [(r["_versao"], r["operacao"], r["linhas_escritas"]) for r in ledger] == [
        (0, "create", 5),
        (1, "load", 7),
    ]
    both = governance.snapshot_compare(rows, "_versao", "_ingerido_em").collect()
    assert [(r["carga"], r["_versao"], r["linhas"]) for r in both] == [
        ("primeira carga", 0, 5),
        ("carga atual", 1, 7),
    ]


@pytest.fixture(params=["table", "path"])
def target(request, tmp_path):
    name = f"t_{abs(hash(request.node.name))}"
    return f"t_publish.{name}" if request.param == "table" else str(tmp_path / name)


def broken(spark):
    return spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken"))))


def test_a_refresh_that_fails_keeps_the_old_rows(spark, target):
    publish(spark.range(4), target)
    with pytest.raises(Exception, match="broken"):
        publish(broken(spark), target)
    assert stored(spark, target).count() == 4
    assert publish(spark.range(6), target) == 6
    assert landed(stored(spark, target)) == [(i,) for i in range(6)]


def test_a_load_that_fails_keeps_all_loads(spark, target):
    publish(spark.range(4), target, version=0)
    with pytest.raises(Exception, match="broken"):
        publish(broken(spark), target, version=0)
    assert stored(spark, target).count() == 4


def test_a_refresh_that_stops_before_the_swap_leaves_the_old_rows(spark, target, monkeypatch):
    """The new files are all there, the target still shows the old ones; the next refresh clears them away."""
    from aerolake.operators import publish as writer

    publish(spark.range(4).withColumn("p", F.col("id") % 2), target, {"id": "A number."}, ["p"])
    with monkeypatch.context() as patched:
        patched.setattr(writer, "_same_shape", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        patched.setattr(writer, "_refresh_path", lambda df, place, by: (df.write.parquet(f"{place}{writer.REFRESH}x"), 1 / 0))
        with pytest.raises((KeyboardInterrupt, ZeroDivisionError)):
            publish(spark.range(9).withColumn("p", F.col("id") % 2), target, {"id": "A number."}, ["p"])
    rows = stored(spark, target)
    assert landed(rows.select("id", "p")) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    if "." in target and "/" not in target:
        assert rows.schema["id"].metadata["comment"] == "A number."
    assert publish(spark.range(5).withColumn("p", F.col("id") % 2), target, {"id": "A number."}, ["p"]) == 5
    assert stored(spark, target).count() == 5


@pytest.mark.parametrize("by", [[], ["p"]])
def test_a_reader_sees_the_old_rows_or_the_new_ones(spark, by):
    """While a table is refreshed again and again, every count is that of one refresh."""
    from threading import Event, Thread

    name = f"t_publish.swap_{len(by)}"
    rows = {n: spark.range(n).withColumn("p", F.col("id") % 3) for n in (400, 600)}
    publish(rows[400], name, partition_by=by)
    seen, done = set(), Event()

    def read():
        while not done.is_set():
            spark.catalog.refreshTable(name)
            seen.add(spark.table(name).count())

    reader = Thread(target=read)
    reader.start()
    for turn in range(6):
        before = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()[1]
        assert publish(rows[(600, 400)[turn % 2]], name, partition_by=by) == (600, 400)[turn % 2]
        # A query planned before the swap still finds its files.
        assert spark.read.parquet(before).count() == (400, 600)[turn % 2]
    done.set()
    reader.join()
    assert seen and seen <= {400, 600}


def test_rows_are_counted_by_the_write(spark, target):
    """A refresh is one job and reads nothing back; a path has its columns read from footers, by two jobs."""
    rows = spark.range(1000).withColumn("x", F.lit("a"))
    publish(rows, target)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    assert publish(rows.where("id < 700"), target) == 700
    jobs = tracker.getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("after", "")
    assert len(jobs) == (3 if "/" in target else 1)


def test_refresh_changes_partitions_and_comments(spark):
    name = "t_publish.shape"
    publish(spark.range(6).withColumn("p", F.col("id") % 2), name, {"id": "It's a \\ number."}, ["p"])
    publish(spark.range(8).withColumn("q", F.col("id") % 4), name, {"id": "Another."}, ["q"])
    assert spark.table(name).schema["id"].metadata["comment"] == "Another."
    assert landed(spark.table(name).groupBy("q").count()) == [(0, 2), (1, 2), (2, 2), (3, 2)]
    assert "PartitionFilters: [isnotnull(q" in plan(spark.table(name).where("q = 1"))


def test_versioned_loads_widen_the_schema(spark, target):
    publish(spark.range(2).withColumn("x", F.lit("a")), target, version=0)
    publish(spark.range(3).withColumn("novo", F.lit(7)), target, version=1)
    rows = stored(spark, target).select("id", "x", "novo", "_versao")
    assert landed(rows) == sorted(
        [(0, "a", None, 0), (1, "a", None, 0), (0, None, 7, 1), (1, None, 7, 1), (2, None, 7, 1)], key=str
    )


def test_a_plain_refresh_does_not_erase_kept_loads(spark, target):
    publish(spark.range(2), target, version=0)
    with pytest.raises(KeptLoads):
        publish(spark.range(3), target)
    assert stored(spark, target).count() == 2


def test_every_write_is_logged(spark, target):
    log = f"t_publish.log_{abs(hash(target))}"
    publish(spark.range(2), target, log=log)
    publish(spark.range(3), target, log=log)
    rows = spark.table(log).orderBy("instante").select("tabela", "versao", "operacao", "linhas").collect()
    assert [tuple(r) for r in rows] == [(target, None, "create", 2), (target, None, "refresh", 3)]


def test_the_callers_overwrite_mode_stays(spark, tmp_path):
    """After a query and a publish, a plain partitioned overwrite still replaces the whole table."""
    publish(spark.range(4), str(tmp_path / "other"), version=1)
    rows = spark.range(6).withColumn("p", F.col("id") % 3)
    for part in (rows, rows.where("p = 1")):
        part.write.mode("overwrite").partitionBy("p").parquet(str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2


def test_a_rewritten_table_shows_its_new_columns(spark, tmp_path):
    from aerolake.sources import views

    spark.range(3).write.parquet(str(tmp_path / "part.parquet"))
    assert views.table(spark, str(tmp_path), "part").columns == ["id"]
    spark.range(3).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert views.table(spark, str(tmp_path), "part").where("more = 1").count() == 3


# --- the whole build -------------------------------------------------------------------------

FLIGHT_HEADER = list(layouts.FLIGHT_COLUMNS)


def flight(**changed):
    row = {
        "icao_empresa": "AZU",
        "numero_voo": "0042",
        "codigo_di": "0",
        "codigo_tipo_linha": "N",
        "icao_origem": "SBRB",
        "icao_destino": "SBGR",
        "partida_prevista": "2025-01-05 10:00:00",
        "partida_real": "2025-01-05 10:20:00.5",
        "chegada_prevista": "2025-01-05 12:00:00",
        "chegada_real": "2025-01-05 12:05:00",
        "situacao_voo": "REALIZADO",
        "codigo_justificativa": "N/A",
    } | changed
    return [row[layouts.FLIGHT_COLUMNS[h]] for h in FLIGHT_HEADER]


@pytest.fixture
def sources(tmp_path):
    quoted = lambda fields: ";".join(f'"{f}"' for f in fields)
    gone = {"partida_real": "null", "chegada_real": "null", "situacao_voo": "CANCELADO"}
    january = [flight(), flight(), flight(icao_empresa="XXX", icao_destino="KJFK", codigo_di="1")]
    february = [flight(partida_prevista="null", codigo_tipo_linha="I"), flight(**gone)]
    for name, rows in (("jan", january), ("feb", february)):
        lines = [PREAMBLE, quoted(FLIGHT_HEADER), *map(quoted, rows)]
        write(tmp_path / f"VRA_{name}.csv", lines, bom=True)
    write(
        tmp_path / "aero.csv",
        [
            PREAMBLE,
            ";".join(layouts.AERODROME_COLUMNS),
            "SBRB;AC0001;Plácido de Castro;Rio Branco;Acre;Rio Branco;Acre;9° 52' 08\" S;67° 53' 53\" W;193,5;Aberto",
            "SBGR;SP0002;Guarulhos;Guarulhos;São Paulo;São Paulo;São Paulo;23° 26' 08\" S;46° 28' 23\" W;750;Aberto",
        ],
        "iso-8859-1",
    )
    header = ";".join(layouts.AIRLINE_COLUMNS)
    write(tmp_path / "nac.csv", [PREAMBLE, header, 'AZU;AD;"AZUL; LINHAS";REGULAR;Barueri;SP;ATIVA'])
    write(tmp_path / "est.csv", [PREAMBLE, header, "TAP;TP;TAP;REGULAR;Lisboa;;ATIVA", ";;SEM CODIGO;;;;"])
    return pipeline.Inputs(
        str(tmp_path / "VRA_*.csv"),
        str(tmp_path / "aero.csv"),
        str(tmp_path / "nac.csv"),
        str(tmp_path / "est.csv"),
    )


def test_pipeline(spark, sources):
    options = pipeline.Options(run_date=dt.date(2026, 2, 1))
    written = pipeline.run(spark, sources, options)
    assert {k: v for k, v in written.items() if not k.startswith("governanca")} == {
        "bronze.vra": 5,
        "bronze.aerodromos": 2,
        "bronze.empresas_nacionais": 1,
        "bronze.empresas_estrangeiras": 2,
        "bronze.codigos_operacao": 13,
        "silver.vra": 5,
        "silver.empresas": 3,
        "silver.aerodromos": 2,
        "silver.codigos_operacao": 13,
        "gold.obt_voos": 5,
        "gold.dim_aeroporto": 3,
        "gold.fato_voos": 5,
        "gold.obt_voos_enriquecida": 5,
    }
    files = quality.manifest(spark.table("bronze.vra"), "_arquivo_origem", "_ingerido_em").collect()
    assert [(r["_arquivo_origem"], r["linhas"]) for r in files] == [("VRA_feb.csv", 2), ("VRA_jan.csv", 3)]

    fact = spark.table("gold.fato_voos")
    known = fact.where("icao_empresa = 'AZU' AND voo_realizado AND mes_referencia IS NOT NULL").collect()
    assert len(known) == 2
    assert known[0]["nome_companhia"] == "AZUL; LINHAS"
    assert (known[0]["atraso_partida_min"], known[0]["atraso_chegada_min"]) == (20, 5)
    assert (known[0]["partida_pontual"], known[0]["chegada_pontual"]) == (False, True)
    assert known[0]["rota"] == "SBRB - SBGR"
    stranger = fact.where("icao_empresa = 'XXX'").first()
    assert (stranger["nome_companhia"], stranger["descricao_di"]) == (None, None)

    wide = spark.table("gold.obt_voos_enriquecida").where("icao_empresa = 'XXX'").first()
    assert wide["nome_companhia"] == "COMPANHIA NAO CADASTRADA XXX"
    assert wide["nome_aeroporto_destino"] == "AEROPORTO FORA DO CADASTRO ANAC KJFK"
    assert wide["rota_municipios"] == "Rio Branco - KJFK"
    assert wide["dia_semana"] == "domingo"

    airports = {r["icao"]: r["altitude_m"] for r in spark.table("silver.aerodromos").collect()}
    assert airports == {"SBRB": 193.5, "SBGR": 750.0}

    # every published column is described
    covered = governance.doc_coverage(spark.table("governanca.dicionario"), ("camada", "tabela"))
    assert {r["pct_documentado"] for r in covered.collect()} == {100.0}
    told = spark.table("governanca.dicionario").where("coluna = ''")
    assert told.count() == len(pipeline.PUBLISHED)
    checks = {(r["verificacao"], r["alvo"]): r["diferenca"] for r in spark.table("governanca.verificacoes").collect()}
    assert len(checks) == 12 and set(checks.values()) == {0}
    tags = governance.tag_listing(spark.table("governanca.etiquetas"), "gold").collect()
    assert len(tags) == 20

    edges = governance.lineage_edges(spark.table("governanca.linhagem"), "gold.", dt.date(2026, 2, 5))
    assert ("silver.vra", "gold.fato_voos") in {tuple(r) for r in edges.collect()}

    # the fact is a row-by-row result of the stored legs, so its write needs no exchange
    silver = [spark.table(f"silver.{t}") for t in ("vra", "empresas", "codigos_operacao")]
    assert "Exchange hashpartitioning" not in plan(gold.fact_legs(*silver))

    # every write is on record
    log = spark.table("governanca.cargas").where("tabela = 'gold.fato_voos'")
    assert log.select("operacao", "linhas").collect()[0]["linhas"] == 5

    # a second run gives the same tables
    again = pipeline.run(spark, sources, options)
    assert again == written


def test_pipeline_options(spark, sources):
    options = pipeline.Options(
        run_date=dt.date(2026, 2, 1), partitioned=False, version=3, dedupe_fact=True, on_duplicate="error"
    )
    written = pipeline.run(spark, sources, options)
    assert written["silver.vra"] == 5
    assert written["gold.fato_voos"] == 4  # the two identical January legs count once
    assert spark.table("gold.fato_voos").columns[-1] == "_processado_em"


def test_checks_show_what_went_wrong(spark, sources):
    """A lost row, an unread time and a code registered twice each show up, and can stop the build."""
    options = pipeline.Options(run_date=dt.date(2026, 2, 1), strict=True)
    spark.sql("DROP TABLE IF EXISTS bronze.vra")
    pipeline.run(spark, sources, options)
    legs = spark.table("silver.vra")
    publish(legs.where("icao_empresa <> 'XXX'").withColumn("chegada_real", F.lit(None).cast("timestamp")), "silver.vra")
    airlines = spark.table("silver.empresas")
    publish(airlines.unionByName(airlines.where("icao = 'TAP'")), "silver.empresas")
    with pytest.raises(pipeline.Breach, match="chave_unica silver.empresas: 0 expected, 1 found"):
        pipeline.build_checks(spark, options)
    found = spark.table("governanca.verificacoes").where("diferenca <> 0").collect()
    assert {(r["verificacao"], r["alvo"]): r["diferenca"] for r in found} == {
        ("linhas", "silver.vra"): 1,
        ("linhas", "silver.empresas"): -1,
        ("linhas", "gold.obt_voos"): -1,
        ("linhas", "gold.obt_voos_enriquecida"): -1,
        ("linhas", "gold.fato_voos"): -1,
        ("chave_unica", "silver.empresas"): -1,
        ("tempo_lido", "silver.vra.partida_prevista"): 1,
        ("tempo_lido", "silver.vra.partida_real"): 1,
        ("tempo_lido", "silver.vra.chegada_prevista"): 1,
        ("tempo_lido", "silver.vra.chegada_real"): 4,
    }


def test_checks_read_each_table_once_for_all_its_times(spark, sources):
    options = pipeline.Options(run_date=dt.date(2026, 2, 1))
    spark.sql("DROP TABLE IF EXISTS bronze.vra")
    pipeline.run(spark, sources, options)
    scans = [line for line in plan(pipeline.stored_checks(spark, options)).split("\n") if "FileScan" in line]
    for table in ("bronze", "silver"):
        timed = [line for line in scans if f"{table}.vra[" in line and "partida_real" in line]
        assert len(timed) == 1 and "chegada_prevista" in timed[0]


def test_glossary_has_no_column_of_its_own(spark):
    """A stale description or an undescribed column shows up as a gap."""
    schema = governance.seed_table(
        spark, [("gold", "t", "icao", None), ("gold", "t", "nova", None)], governance.DICTIONARY
    )
    told = governance.seed_table(
        spark,
        [("gold", "t", "icao", GLOSSARY["icao"]), ("gold", "t", "velha", "x")],
        governance.DICTIONARY,
    )
    gaps = {(r["coluna"], r["falta"]) for r in governance.dictionary_gaps(told, schema).collect()}
    assert gaps == {("nova", "sem_comentario"), ("velha", "sem_coluna")}
