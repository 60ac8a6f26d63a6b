from pyspark.sql import functions as F

from medallion.operators import gold
from medallion.operators.silver import percent_rank_pct, transform_silver

COLS = ("nu_inscricao string, ano int, sg_uf_residencia string, regiao string, tp_escola string, "
        "renda_familiar string, in_treineiro int, tp_presenca string, nu_nota_cn double, nu_nota_ch double, "
        "nu_nota_lc double, nu_nota_mt double, nu_nota_redacao double")

ROWS = [
    ("1", 2021, "SP", "Sudeste", "Pública Estadual", "Nenhuma", 0, "Presente", 700.0, 700.0, 700.0, 700.0, 700.0),
    ("2", 2021, "SP", "Sudeste", "Privada", "5-10 SM", 0, "Presente", 600.0, 600.0, 600.0, 600.0, 600.0),
    ("3", 2021, "RJ", "Sudeste", None, "1-2 SM", 0, "Presente", 500.0, 500.0, 500.0, 500.0, 500.0),
    ("4", 2021, "RJ", "Sudeste", "Privada", "??", 0, "Presente", 400.0, 400.0, 400.0, 400.0, 400.0),
    # four scores summing to 2049.3: mean 512.325, an exact rounding tie
    ("5", 2021, "BA", "Nordeste", "Privada", "Até 1 SM", 0, "Presente", 512.3, 512.3, 512.3, 512.4, 520.0),
    ("6", 2021, "BA", "Nordeste", "Privada", "Até 1 SM", 0, "Presente", 600.0, 600.0, 600.0, 600.0, 600.0),
    ("7", 2021, "BA", "Nordeste", "Privada", "Até 1 SM", 0, "Presente", None, None, None, None, None),
    ("8", 2021, "BA", "Nordeste", "Privada", "Até 1 SM", 1, "Presente", 900.0, 900.0, 900.0, 900.0, 900.0),
    ("9", 2021, "BA", "Nordeste", "Privada", "Até 1 SM", 0, "Ausente", None, None, None, None, None),
    ("10", 2022, "BA", "Nordeste", "Privada", "Até 1 SM", 0, "Presente", 300.0, 300.0, 300.0, 300.0, 300.0),
]


def silver(spark):
    return transform_silver(spark.createDataFrame(ROWS, COLS), audit=False)


def test_silver_rules(spark):
    s = {r["nu_inscricao"]: r for r in silver(spark).collect()}
    assert set(s) == {"1", "2", "3", "4", "5", "6", "7", "10"}  # trainee and absent dropped
    assert s["1"]["faixa_desempenho"] == "Excelente" and s["2"]["faixa_desempenho"] == "Bom"
    assert s["3"]["faixa_desempenho"] == "Regular" and s["4"]["faixa_desempenho"] == "Abaixo da Média"
    assert s["5"]["media_objetivas"] == 512.33  # tie rounds up
    assert s["7"]["media_geral"] is None and s["7"]["faixa_desempenho"] == "Insuficiente"
    assert s["4"]["grupo_renda"] == "Alta" and s["3"]["grupo_renda"] == "Média" and s["5"]["grupo_renda"] == "Baixa"
    assert s["3"]["fl_escola_publica"] == 0 and s["1"]["fl_escola_publica"] == 1


def test_percent_rank_strategies_agree(spark):
    df = silver(spark)
    w = {r[0]: r[1] for r in percent_rank_pct(df, strategy="window").select("nu_inscricao", "percentil_nacional").collect()}
    h = {r[0]: r[1] for r in percent_rank_pct(df, strategy="histogram").select("nu_inscricao", "percentil_nacional").collect()}
    b = {r[0]: r[1] for r in percent_rank_pct(df, strategy="histogram", n_buckets=3)
         .select("nu_inscricao", "percentil_nacional").collect()}
    assert w == h == b
    assert w["7"] == 0.0     # NULL mean sorts first
    assert w["10"] == 0.0    # one-row year


def test_percent_rank_random_equivalence(spark):
    import random
    rnd = random.Random(7)
    data = [(rnd.choice([2020, 2021, 2022]), rnd.choice([None] + [round(rnd.uniform(0, 50), 1) for _ in range(40)]))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "ano int, v double").withColumn("id", F.monotonically_increasing_id())
    a = sorted(percent_rank_pct(df, ["ano"], "v", "p", strategy="window").select("id", "p").collect())
    b = sorted(percent_rank_pct(df, ["ano"], "v", "p", strategy="histogram", n_buckets=5).select("id", "p").collect())
    assert a == b


def test_gold_marts(spark):
    df = percent_rank_pct(silver(spark))
    uf = {(r["uf"], r["ano"]): r for r in gold.performance_by_uf(df).collect()}
    sp = uf[("SP", 2021)]
    assert sp["total_candidatos"] == 2 and sp["media_geral"] == 650.0
    assert sp["pct_escola_publica"] == 50.0 and sp["pct_excelente"] == 50.0
    assert uf[("BA", 2021)]["total_candidatos"] == 2  # the NULL mean is excluded before grouping
    assert uf[("BA", 2022)]["total_candidatos"] == 1
    yoy = {(r["regiao"], r["ano"]): r for r in gold.yearly_evolution(df).collect()}
    first = yoy[("Nordeste", 2021)]
    assert first["media_geral_ano_anterior"] is None
    second = yoy[("Nordeste", 2022)]
    assert second["media_geral_ano_anterior"] == first["media_geral"]
    assert second["variacao_yoy"] == round(second["media_geral"] - first["media_geral"], 2)
