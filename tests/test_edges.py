"""Edge rows of single operators, each with its expected value."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aerolake.functions import clock, measures, text
from aerolake.operators import conform, governance, lookups, quality
from aerolake.plans import consumption, gold, silver
from aerolake.session import partitions_for, size_shuffles
from aerolake.sources.delimited import parse_delimited
from aerolake.sources.seed import OPERATION_CODES, operation_codes, seed_table


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def of(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def times(spark, *pairs):
    texts = of(spark, "i int, a string, b string", *[(i, *p) for i, p in enumerate(pairs)])
    return conform.parse_timestamps(texts, ["a", "b"]).orderBy("i")


def test_nullify_is_exact(spark):
    df = of(spark, "i int, t string", (0, "null"), (1, "NULL"), (2, ""), (3, None), (4, "null "))
    assert column(conform.nullify(df, {"t": "null"}).orderBy("i"), "t") == [None, "NULL", "", None, "null "]


def test_lenient_times(spark):
    df = of(
        spark,
        "i int, t string",
        (0, "2025-01-05 10:20:30.5"),
        (1, "2025"),
        (2, " 2025-01-05 "),
        (3, "2025-13-01"),
        (4, "sem hora"),
    )
    assert column(conform.parse_timestamps(df, ["t"]).orderBy("i"), "t") == [
        dt.datetime(2025, 1, 5, 10, 20, 30, 500000),
        dt.datetime(2025, 1, 1),
        dt.datetime(2025, 1, 5),
        None,
        None,
    ]


def test_strict_times_refuse_what_the_lenient_cast_guesses(spark):
    df = of(
        spark,
        "i int, t string",
        (0, "2025-01-05 10:20:30.5"),
        (1, "2025-01-05 10:20:30"),
        (2, "10:00"),
        (3, "2025"),
        (4, "05/01/2025 10:20"),
        (5, None),
    )
    formats = ["yyyy-MM-dd HH:mm:ss[.SSSSSS]", "dd/MM/yyyy HH:mm"]
    assert column(conform.parse_timestamps(df, ["t"], formats).orderBy("i"), "t") == [
        dt.datetime(2025, 1, 5, 10, 20, 30, 500000),
        dt.datetime(2025, 1, 5, 10, 20, 30),
        None,
        None,
        dt.datetime(2025, 1, 5, 10, 20),
        None,
    ]


def test_split_time(spark):
    row = conform.split_time(times(spark, ("2025-01-05 09:07:59", None)), ["a", "b"]).first()
    assert (row["a_data"], row["a_hora"]) == (dt.date(2025, 1, 5), "09:07")
    assert (row["b_data"], row["b_hora"]) == (None, None)


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2025-01-01 10:00:59", "2025-01-01 10:01:00", 0),
        ("2025-01-01 10:00:30", "2025-01-01 10:00:00", 0),
        ("2025-01-01 10:01:30", "2025-01-01 10:00:00", -1),
        ("2025-01-01 23:50:00", "2025-01-02 00:10:00", 20),
        ("null", "2025-01-02 00:10:00", None),
        ("0001-01-01 00:00:00", "9999-12-31 00:00:00", None),  # more minutes than an int holds
    ],
)
def test_elapsed_minutes(spark, start, end, minutes):
    assert column(conform.elapsed_minutes(times(spark, (start, end)), "a", "b", "m"), "m") == [minutes]


def test_regained_minutes_truncates_each_side(spark):
    df = of(
        spark,
        "p string, q string, r string, s string",
        ("2025-01-01 10:00:00", "2025-01-01 10:10:59", "2025-01-01 12:00:00", "2025-01-01 12:05:01"),
    )
    df = conform.parse_timestamps(df, df.columns)
    assert column(conform.regained_minutes(df, ("p", "q"), ("r", "s"), "m"), "m") == [5]


def test_decimal_comma(spark):
    df = of(
        spark,
        "i int, t string",
        *enumerate(["193,5", "-3,25", "750", "1.193,5", "12d", "", None, "alto"]),
    )
    assert column(conform.decimal_comma(df, "t", "m").orderBy("i"), "m") == [
        193.5,
        -3.25,
        750.0,
        None,
        12.0,
        None,
        None,
        None,
    ]


def test_punctuality_rules_differ_on_purpose(spark):
    df = times(
        spark,
        ("2025-01-01 10:00:00", "2025-01-01 10:00:00"),
        ("2025-01-01 10:00:00", "2025-01-01 10:00:01"),
        ("null", "2025-01-01 10:00:00"),
        ("2025-01-01 10:00:00", "null"),
    )
    assert column(conform.on_time_by_clock(df, "a", "b", "p").orderBy("i"), "p") == [
        True,
        False,
        False,
        None,
    ]
    delayed = conform.elapsed_minutes(df, "a", "b", "m")
    assert column(conform.on_time(delayed, "m", "p").orderBy("i"), "p") == [True, True, None, None]


@pytest.mark.parametrize("minutes, answer", [(15, True), (16, False), (-40, True), (None, None)])
def test_on_time_threshold(spark, minutes, answer):
    assert column(conform.on_time(of(spark, "m int", (minutes,)), "m", "p"), "p") == [answer]


def test_classify(spark):
    df = of(spark, "i int, c string", *enumerate(["N", "C", "I", "G", "Z", None]))
    assert column(conform.classify(df, "c", gold.SCOPES, "s").orderBy("i"), "s") == [
        "Domestico",
        "Domestico",
        "Internacional",
        "Internacional",
        None,
        None,
    ]
    places = of(spark, "i int, c string", *enumerate(["SBGR", "SWFX", "KJFK", "sbgr"]))
    placed = conform.classify(places, "c", gold.HOME, "p", gold.ABROAD, by_prefix=True)
    assert column(placed.orderBy("i"), "p") == ["Brasil", "Exterior", "Exterior", "Exterior"]


def test_calendar_parts(spark):
    df = times(spark, ("2025-01-05 00:30:00", "null"), ("null", "null"))
    english = conform.calendar_parts(df, "a").collect()
    assert (english[0]["hora_partida_prevista"], english[0]["dia_semana"]) == (0, "sunday")
    assert english[0]["mes_referencia"] == dt.datetime(2025, 1, 1)
    assert [english[1][c] for c in ("hora_partida_prevista", "dia_semana", "mes_referencia")] == [None] * 3


@pytest.mark.parametrize("codegen", ["true", "false"])
def test_portuguese_weekdays(spark, codegen):
    days = [f"2025-01-{d:02d} 12:00:00" for d in range(5, 12)]
    spark.conf.set("spark.sql.codegen.wholeStage", codegen)
    try:
        df = times(spark, *[(d, None) for d in days], (None, None))
        got = column(conform.calendar_parts(df, "a", "pt"), "dia_semana")
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")
    assert got == [*clock.WEEKDAYS["pt"], None]


def test_english_weekdays_match_date_format(spark):
    days = [f"2025-02-{d:02d} 12:00:00" for d in range(1, 29)]
    df = conform.calendar_parts(times(spark, *[(d, None) for d in days]), "a")
    assert df.where("dia_semana <> lower(date_format(a, 'EEEE'))").count() == 0


def test_unknown_locale():
    with pytest.raises(ValueError):
        clock.weekday(None, "fr")


def test_route_needs_both_ends(spark):
    df = of(spark, "i int, a string, b string", (0, "SBGR", "KJFK"), (1, "SBGR", None), (2, "SBGR", ""))
    assert column(conform.route(df, "a", "b", "r").orderBy("i"), "r") == ["SBGR - KJFK", None, "SBGR - "]


def test_stamp(spark):
    row = conform.stamp(conform.stamp(spark.range(1), "f", "a.csv"), "t").first()
    assert row["f"] == "a.csv" and isinstance(row["t"], dt.datetime)


def test_flag_of_the_plain_rule(spark):
    """A flown leg on known times with its metric missing is flagged; nothing else is."""
    legs = times(spark, ("2025-01-01 10:00:00", "2025-01-01 10:05:00")).selectExpr(
        "a AS partida_prevista",
        "b AS partida_real",
        "CAST(NULL AS INT) AS atraso_partida_min",
        "CAST(NULL AS INT) AS atraso_chegada_min",
        "CAST(NULL AS INT) AS minutos_recuperados",
        "'N' AS codigo_tipo_linha",
        "'SBGR' AS icao_origem",
        "'KJFK' AS icao_destino",
        "'REALIZADO' AS situacao_voo",
    )
    assert column(gold.leg_rules(legs), "atraso_fora_de_faixa") == [True]
    unknown = legs.withColumn("situacao_voo", F.lit(None).cast("string"))
    row = gold.leg_rules(unknown).first()
    assert row["atraso_fora_de_faixa"] is False
    assert (row["voo_realizado"], row["voo_cancelado"]) == (None, None)


@pytest.mark.parametrize(
    "departure, arrival, flagged",
    [
        (-120, 1440, False),
        (-121, 0, True),
        (0, 1441, True),
        (None, None, False),
        (None, 2000, True),
        (5, None, False),
        (2000, None, True),
    ],
)
def test_quarantine_bounds(spark, departure, arrival, flagged):
    df = of(spark, "d int, a int, r int", (departure, arrival, 7))
    row = quality.quarantine_range(df, ["d", "a"], ["d", "a", "r"], "f").first()
    assert row["f"] is flagged
    assert (row["d"], row["a"], row["r"]) == ((None,) * 3 if flagged else (departure, arrival, 7))


def test_dedupe_ignores_audit_and_keeps_nulls(spark):
    df = of(
        spark,
        "a string, b int, _ingerido_em int",
        ("x", None, 3),
        ("x", None, 1),
        ("x", 1, 2),
        (None, None, 5),
        (None, None, 5),
    )
    once = quality.dedupe_exact(df)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        [("x", None, 1), ("x", 1, 2), (None, None, 5)], key=str
    )
    assert once.columns == df.columns
    assert sorted(quality.dedupe_exact(once).collect(), key=str) == sorted(once.collect(), key=str)


def test_profiles_of_nothing(spark):
    empty = of(spark, "a string")
    row = quality.profile(
        empty,
        {
            "n": measures.rows(),
            "f": measures.filled("a"),
            "h": measures.hits(F.col("a") == "x"),
            "s": measures.hits_or_null(F.col("a") == "x"),
            "p": measures.percent(measures.filled("a"), measures.rows()),
        },
    ).first()
    assert tuple(row) == (0, 0, 0, None, None)


def test_parity_shows_lost_rows(spark):
    row = quality.row_parity({"b": spark.range(5)}, "s", spark.range(3)).first()
    assert row.asDict() == {"b": 5, "s": 3, "diferenca": 2}
    row = quality.row_parity(
        {"x": spark.range(2), "y": spark.range(0)}, "u", spark.range(2), "soma", None
    ).first()
    assert row.asDict() == {"x": 2, "y": 0, "soma": 2, "u": 2}


def test_earliest_puts_unknown_first(spark):
    df = times(spark, ("2025-01-02", None), ("null", None), ("2025-01-01", None), ("null", None))
    assert column(quality.earliest(df, "a", 3, ["i"]), "i") == [1, 3, 2]


def test_sample_by_keys_is_sorted(spark):
    df = of(spark, "k string, v int", ("b", 2), ("a", 1), ("c", 3), ("a", 0))
    assert column(quality.sample_by_keys(df, "k", ["a", "b"], ["k", "v"], ["k", "v"]), "v") == [0, 1, 2]


# --- lookups ---------------------------------------------------------------------------------


@pytest.fixture
def registry(spark):
    return of(spark, "icao string, nome string", ("A", "Alfa"), ("B", None), ("", "sem"), (None, "nada"))


def test_lookup_keeps_all_rows(spark, registry):
    legs = of(spark, "i int, k string", (0, "A"), (1, "B"), (2, "Z"), (3, None))
    found = lookups.join_lookup(
        legs, registry, "k", "icao", {"nome": "n"}, fallback={"n": "FORA "}, present_flag="tem"
    ).orderBy("i")
    assert [tuple(r) for r in found.collect()] == [
        (0, "A", "Alfa", True),
        (1, "B", "FORA B", True),
        (2, "Z", "FORA Z", False),
        (3, None, None, False),
    ]


@pytest.mark.parametrize("salts", [1, 5])
def test_duplicate_policies(spark, registry, salts):
    legs = of(spark, "i int, k string", *[(i, "A") for i in range(20)], (20, "Z"))
    twice = registry.unionByName(of(spark, "icao string, nome string", ("A", "Alba"), ("", "outra")))

    def joined(policy):
        return lookups.join_lookup(
            legs, twice, "k", "icao", {"nome": "n"}, on_duplicate=policy, salts=salts
        )

    assert joined("keep").count() == 41
    merged = joined("merge")
    assert merged.count() == 21
    assert {r["n"] for r in merged.collect()} == {"Alba", None}
    with pytest.raises(PySparkException, match="more than once: A"):
        joined("error").collect()
    with pytest.raises(ValueError):
        joined("first")


def test_error_policy_accepts_a_clean_lookup(spark, registry):
    legs = of(spark, "k string", ("A",), ("Z",))
    found = lookups.join_lookup(legs, registry, "k", "icao", {"nome": "n"}, on_duplicate="error")
    assert {tuple(r) for r in found.collect()} == {("A", "Alfa"), ("Z", None)}


def test_domain_filters_the_lookup_only(spark):
    codes = operation_codes(spark)
    assert codes.count() == len(OPERATION_CODES) == 13
    legs = of(spark, "codigo_di string, codigo_tipo_linha string", ("0", "N"), ("N", "0"), ("1", None))
    got = {tuple(r) for r in gold.decode_codes(legs, codes).collect()}
    assert got == {
        ("0", "N", "Etapa Regular", "Doméstica Mista"),
        ("N", "0", None, None),
        ("1", None, None, None),
    }


def test_key_set_skips_blank_and_null(spark):
    df = of(spark, "a string, b string", ("x", "y"), ("", "x"), (None, ""), ("z", None))
    assert sorted(column(lookups.key_set(df, ["a", "b"], "k"), "k")) == ["x", "y", "z"]


def test_dimension_covers_all_keys(spark):
    legs = of(spark, "icao_origem string, icao_destino string", ("SBGR", "KJFK"), ("", "SBXX"))
    airports = of(
        spark,
        "icao string, nome string, municipio string, uf_nome string",
        ("SBGR", "Guarulhos", "Guarulhos", "São Paulo"),
    )
    dim = gold.dim_airport(legs, airports)
    rows = {r["icao_aeroporto"]: r for r in dim.collect()}
    assert set(rows) == {"SBGR", "KJFK", "SBXX"}
    assert rows["SBXX"]["nome_aeroporto"] == "AEROPORTO FORA DO CADASTRO ANAC SBXX"
    assert (rows["SBXX"]["pais_aeroporto"], rows["SBXX"]["no_cadastro_anac"]) == ("Brasil", False)
    sides = ("icao_origem", "icao_destino")
    assert lookups.uncovered_keys(legs, sides, dim, "icao_aeroporto").count() == 0
    missing = lookups.coverage(legs, sides, {"dim": (dim, "icao_aeroporto"), "reg": (airports, "icao")})
    assert {tuple(r) for r in missing.collect()} == {
        ("reg", "icao_destino", "KJFK", 1),
        ("reg", "icao_destino", "SBXX", 1),
    }


def test_registry_and_dimension_give_the_same_roles(spark):
    """Also for blank and missing codes, which no dimension row stands for."""
    codes = ["SBGR", "SBXX", "KJFK", "", None]
    pairs = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in codes for b in codes)]
    legs = of(spark, "i int, icao_origem string, icao_destino string", *pairs)
    airports = of(
        spark,
        "icao string, nome string, municipio string, uf_nome string",
        ("SBGR", "Guarulhos", "Guarulhos", "São Paulo"),
        ("KJFK", None, None, None),
    )
    by_dim = gold.role_play(legs, gold.dim_airport(legs, airports)).orderBy("i")
    by_registry = gold.role_play_registry(legs, airports).select(*by_dim.columns).orderBy("i")
    assert by_dim.collect() == by_registry.collect()


def test_duplicate_keys_with_and_without_fact(spark, registry):
    twice = registry.unionByName(registry)
    assert sorted(column(lookups.duplicate_keys(twice, "icao"), "chave")) == ["", "A", "B"]
    legs = of(spark, "k string", ("A",), ("A",), ("Z",))
    touched = lookups.duplicate_keys(twice, "icao", legs, "k").orderBy("chave").collect()
    assert [tuple(r) for r in touched] == [("", 2, 0), ("A", 2, 2), ("B", 2, 0)]


# --- governance ------------------------------------------------------------------------------


def test_lineage_window_and_blank_source(spark):
    day = dt.date(2025, 6, 30)
    rows = [("", "g.a", day), (None, "g.a", day), ("s", "g.a", day - dt.timedelta(days=7))]
    rows += [("old", "g.a", day - dt.timedelta(days=8)), ("s", "other.a", day), ("s", "g.a", day)]
    edges = seed_table(spark, rows, governance.EDGES)
    assert [tuple(r) for r in governance.lineage_edges(edges, "g.", day).collect()] == [
        ("(arquivo no volume)", "g.a"),
        ("s", "g.a"),
    ]


def test_doc_coverage_rounds_to_one_digit(spark):
    rows = [("s", "t", f"c{i}", "x" if i < 2 else ("" if i == 2 else None)) for i in range(6)]
    dictionary = seed_table(spark, rows, governance.DICTIONARY)
    row = governance.doc_coverage(dictionary, ("tabela",)).first()
    assert tuple(row) == ("t", 6, 4, 33.3)


def test_snapshot_compare_of_chosen_loads(spark):
    loads = of(spark, "_versao int, t int", (0, 5), (0, 3), (1, 9), (2, 8), (2, 7))
    rows = governance.snapshot_compare(loads, "_versao", "t", first=1, current=2).collect()
    assert [tuple(r) for r in rows] == [("primeira carga", 1, 1, 9), ("carga atual", 2, 2, 7)]
    rows = governance.snapshot_compare(loads, "_versao", "t", current=1).collect()
    assert [tuple(r) for r in rows] == [("primeira carga", 0, 2, 3), ("carga atual", 1, 1, 9)]


def test_empty_seed(spark):
    assert seed_table(spark, [], governance.TAGS).count() == 0


# --- questions -------------------------------------------------------------------------------


def test_unknown_legs_never_count_as_late(spark):
    fact = of(
        spark,
        "icao_empresa string, partida_pontual boolean, chegada_pontual boolean",
        ("A", True, None),
        ("A", None, None),
        ("A", False, None),
    )
    airlines = of(spark, "icao string, razao_social string", ("A", "Alfa"), ("A", "Zeta"))
    row = consumption.punctuality_rate(fact, airlines).first()
    assert (row["partida_avaliados"], row["partida_pontuais"], row["partida_taxa"]) == (2, 1, 0.5)
    assert (row["chegada_avaliados"], row["chegada_taxa"]) == (0, None)
    assert row["nome_companhia"] == "Alfa"


def test_rate_by_defaults_to_all_rows(spark):
    fact = of(spark, "g string, hit boolean", ("a", True), ("a", None), ("b", False))
    rates = {r["g"]: r["taxa"] for r in consumption.rate_by(fact, ("g",), "hit").collect()}
    assert rates == {"a": 0.5, "b": 0.0}


# --- text rows and sizing --------------------------------------------------------------------


def test_parse_delimited_text(spark):
    df = of(spark, "i int, t string", (0, '1;"a""b";"x;y"'), (1, "2"), (2, "3;;z;sobra"), (3, None))
    parsed = parse_delimited(df, "t", ["a", "b", "c"], escape='"').orderBy("i")
    assert [tuple(r) for r in parsed.collect()] == [
        (0, "1", 'a"b', "x;y"),
        (1, "2", None, None),
        (2, "3", None, "z"),
        (3, None, None, None),
    ]


def test_blank_and_label_helpers(spark):
    df = of(spark, "i int, t string", (0, ""), (1, None), (2, "x"))
    assert column(df.select("i", text.or_label(F.col("t"), "-").alias("o")).orderBy("i"), "o") == ["-", "-", "x"]
    assert column(df.select("i", text.has_text(F.col("t")).alias("o")).orderBy("i"), "o") == [False, False, True]


def test_shuffle_width_follows_the_input(spark):
    assert partitions_for(0, 8) == 8
    assert partitions_for(100 * 1024**4, 200, 2 * 1024**3) == 204_800
    assert partitions_for(3 * 1024**3, 8) == 96
    try:
        assert size_shuffles(spark, 3 * 1024**3) == 96
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_silver_passes_audit_columns_through(spark):
    raw = of(
        spark,
        ", ".join(f"{c} string" for c in (*silver.KEYS, *silver.TIMES, "situacao_voo", "codigo_justificativa"))
        + ", _arquivo_origem string",
        (*["x"] * 6, *["null"] * 4, "CANCELADO", "N/A", "a.csv"),
    )
    legs = silver.legs(raw)
    assert len(legs.columns) == 24 and legs.columns[-1] == "_arquivo_origem"
    row = legs.first()
    assert row["codigo_justificativa"] is None and row["partida_prevista"] is None


def test_build_reads_every_form_that_names_its_moment(spark):
    """Only a bare time of day and a bare year, which the cast would complete by a guess, stay unread."""
    forms = {
        "2025-01-05T10:00:00": "2025-01-05 10:00:00",
        "2025-01-05 10:00:00Z": "2025-01-05 10:00:00",
        "2025-01-05 9:05:00": "2025-01-05 09:05:00",
        " 2025-01-05 10:00:00": "2025-01-05 10:00:00",
        "2025-01-05 10:00:00.123456789": "2025-01-05 10:00:00.123456",
        "2025-01-05": "2025-01-05 00:00:00",
        "2025-01": "2025-01-01 00:00:00",
        "10:00": None,
        "T10:00:00": None,
        " 9:05:00.5 ": None,
        "2025": None,
        "05/01/2025 10:00": None,
        "null": None,
        "": None,
    }
    rows = spark.createDataFrame(list(forms.items()), "t string, want string")
    read = conform.parse_timestamps(rows, ["t"], guess=False)
    assert all(got == want for got, want in read.select(F.col("t").cast("string"), "want").collect())
