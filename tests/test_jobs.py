"""The composite jobs (K1–K5) end to end on a small raw extract."""

import os
import tempfile

from medallion import jobs
from medallion.sources.csv import existing_year_paths
from medallion.sources.snapshots import SnapshotTable

HEADER = ("nu_inscricao,ano,sg_uf_residencia,regiao,tp_sexo,nu_idade,tp_escola,renda_familiar,in_treineiro,"
          "tp_presenca,nu_nota_cn,nu_nota_ch,nu_nota_lc,nu_nota_mt,nu_nota_redacao,dt_carga")
ROWS_2021 = [
    "202100000001,2021,SP,Sudeste,F,17,Pública Estadual,Nenhuma,0,Presente,700,700,700,700,700,2024-01-01 00:00:00",
    "202100000002,2021,RJ,Sudeste,M,18,Privada,5-10 SM,0,Presente,512.3,512.3,512.3,512.4,520,2024-01-01 00:00:00",
    "202100000003,2021,BA,Nordeste,M,19,Privada,1-2 SM,1,Presente,900,900,900,900,900,2024-01-01 00:00:00",
    "202100000004,2021,BA,Nordeste,F,20,Privada,Nenhuma,0,Ausente,,,,,,2024-01-01 00:00:00",
    "202100000005,2021,BA,Nordeste,F,x,Privada,Nenhuma,0,Presente,1,2,3,4,5,2024-01-01 00:00:00",
]
ROWS_2022 = [
    "202200000001,2022,SP,Sudeste,F,17,Pública Federal,Até 1 SM,0,Presente,600,600,600,600,600,2024-01-01 00:00:00",
]


def test_jobs_end_to_end(spark):
    raw = tempfile.mkdtemp(prefix="raw-")
    for year, rows in ((2021, ROWS_2021), (2022, ROWS_2022)):
        with open(os.path.join(raw, f"extract_{year}.csv"), "w") as fh:
            fh.write("\n".join([HEADER] + rows) + "\n")
    out = tempfile.mkdtemp(prefix="tiers-")
    paths = existing_year_paths(spark, raw, [2020, 2021, 2022])
    res = jobs.bronze(spark, paths, f"{out}/bronze", rejects=f"{out}/rejects")
    assert res["rows"] == 5
    assert spark.read.parquet(f"{out}/rejects").count() == 1          # the unparsable age
    table = SnapshotTable(spark, f"{out}/silver", ["ano", "regiao"])
    for _ in range(2):                                                 # twice ≡ once
        jobs.silver(spark, spark.read.parquet(f"{out}/bronze"), table)
    silver = table.read()
    assert sorted(r["nu_inscricao"] for r in silver.collect()) == ["202100000001", "202100000002", "202200000001"]
    assert {r["nu_inscricao"]: r["percentil_nacional"] for r in silver.collect()}["202200000001"] == 0.0
    marts = jobs.gold_marts(silver)
    report = {(r["check"], r["relation"]): r["status"] for r in jobs.quality(marts).collect()}
    assert len(report) == 11 and set(report.values()) == {"pass"}
    pages = jobs.pages(marts, table)
    assert pages["kpis"].first()["n_uf"] == 1                          # latest year: SP only
    assert pages["history"].count() == 4                               # 2 × (upsert + percentile)
    assert pages["file_stats"].count() == 2                            # (2021, Sudeste), (2022, Sudeste)
