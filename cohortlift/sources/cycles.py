"""Treatment-cycle view derived from the ``orders`` table.

One row per order; the text is portable SQL, so the batch queries, the stream
query and the SQL checks all start from the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlift.sources.tables import spread

CYCLES_SQL = """
WITH k AS (SELECT o_orderkey AS k FROM orders),
s1 AS (SELECT k,
  ((k*56189+104729)%1000003%40)=0 AS di, ((k*64107+209458)%1000003%6)=0 AS fet,
  ((k*72025+314187)%1000003%28) AS eggs, ((k*87861+523645)%1000003%10) AS d5 FROM k),
s2 AS (SELECT *, CASE WHEN fet THEN 0 ELSE eggs END AS fresh,
  CASE WHEN fet THEN 0 ELSE eggs-eggs%3 END AS mixed,
  CASE WHEN fet OR ((k*95779+628374)%1000003%2)=0 THEN 0 ELSE eggs-eggs%4 END AS icsi FROM s1),
s3 AS (SELECT *, icsi-icsi%3 AS icsi_emb,
  CASE WHEN fet THEN 0 ELSE mixed-mixed%5 END AS emb,
  CASE WHEN fet THEN 1+((k*103697+733103)%1000003%3) ELSE 0 END AS thawed FROM s2),
s4 AS (SELECT *, CASE WHEN fet THEN thawed WHEN emb=0 OR ((k*111615+837832)%1000003%7)=0 THEN 0 WHEN emb>1 THEN 1+((k*119533+942561)%1000003%2) ELSE 1 END AS trf FROM s3)
SELECT k AS id,
  CASE ((k*127451+1047290)%1000003%7) WHEN 0 THEN 'TRZKPL' WHEN 1 THEN 'TRYBLT' WHEN 2 THEN 'TRVNRY' WHEN 3 THEN 'TRJXFG' WHEN 4 THEN 'TRCMWS' WHEN 5 THEN 'TRXQMD' ELSE 'TRDQAZ' END AS period_code,
  CASE ((k*135369+1152019)%1000003%40) WHEN 39 THEN '알 수 없음' WHEN 38 THEN '만45-50세' WHEN 37 THEN '만43-44세' ELSE CASE ((k*135369+1152019)%1000003%40)%4 WHEN 0 THEN '만18-34세' WHEN 1 THEN '만35-37세' WHEN 2 THEN '만38-39세' ELSE '만40-42세' END END AS age_band,
  CASE WHEN ((k*143287+1256748)%1000003%25)=0 THEN CAST(((k*151205+1361477)%1000003%12) AS DOUBLE) END AS years_trying,
  CASE WHEN di THEN 'DI' ELSE 'IVF' END AS treatment_type,
  CASE WHEN di THEN NULL ELSE CASE ((k*159123+1466206)%1000003%9) WHEN 0 THEN 'ICSI / BLASTOCYST' WHEN 1 THEN 'IVF' WHEN 2 THEN 'IVF / AH' WHEN 3 THEN 'Unknown' WHEN 4 THEN 'ICSI:IVF' WHEN 5 THEN 'ICSI / FER' ELSE 'ICSI' END END AS specific_type,
  ((k*167041+1570935)%1000003%4)%2 AS ovulation_stimulated,
  CASE WHEN ((k*174959+1675664)%1000003%4)=0 THEN '알 수 없음' ELSE '기록되지 않은 시행' END AS induction_type,
  CAST(CASE WHEN di THEN NULL WHEN trf=1 THEN 1 ELSE 0 END AS DOUBLE) AS single_transfer,
  CASE WHEN ((k*182877+1780393)%1000003%90)=0 THEN 1.0E0 END AS pgt_used,
  CASE WHEN di THEN NULL ELSE CAST((((k*190795+1885122)%1000003%200)=0) AS INT)*1.0E0 END AS pgt_diagnosis,
  CAST((((k*198713+1989851)%1000003%30)=0) AS INT) AS cause_male_primary, CAST((((k*206631+2094580)%1000003%50)=0) AS INT) AS cause_male_secondary,
  CAST((((k*214549+2199309)%1000003%30)=0) AS INT) AS cause_female_primary, CAST((((k*222467+2304038)%1000003%50)=0) AS INT) AS cause_female_secondary,
  CAST((((k*230385+2408767)%1000003%40)=0) AS INT) AS cause_couple_primary, CAST((((k*238303+2513496)%1000003%99)=0) AS INT) AS cause_couple_secondary,
  CAST((((k*246221+2618225)%1000003%4)=0) AS INT) AS cause_unexplained,
  CAST((((k*254139+2722954)%1000003%7)=0) AS INT) AS cause_tubal, CAST((((k*262057+2827683)%1000003%3)=0) AS INT) AS cause_male_factor,
  CAST((((k*269975+2932412)%1000003%8)=0) AS INT) AS cause_ovulatory, 0 AS cause_female_factor,
  CAST((((k*277893+3037141)%1000003%2000)=0) AS INT) AS cause_cervical, CAST((((k*285811+3141870)%1000003%13)=0) AS INT) AS cause_endometriosis,
  CAST((((k*293729+3246599)%1000003%40)=0) AS INT) AS cause_sperm_conc, CAST((k=0) AS INT) AS cause_sperm_immune,
  CAST((((k*309565+3456057)%1000003%50)=0) AS INT) AS cause_sperm_motility, CAST((((k*317483+3560786)%1000003%60)=0) AS INT) AS cause_sperm_morph,
  CASE WHEN di THEN NULL ELSE CASE ((k*325401+3665515)%1000003%12) WHEN 0 THEN '기증용, 현재 시술용' WHEN 1 THEN '배아 저장용' WHEN 2 THEN '난자 저장용' WHEN 3 THEN '연구용' ELSE '현재 시술용' END END AS embryo_reason,
  CASE ((k*333319+3770244)%1000003%8) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_cycles, CASE ((k*341237+3874973)%1000003%8) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_clinic_cycles, CASE ((k*349155+3979702)%1000003%8) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_ivf_cycles, CASE ((k*357073+4084431)%1000003%3) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_di_cycles,
  CASE ((k*364991+4189160)%1000003%8) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_pregnancies, CASE ((k*372909+4293889)%1000003%4) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_ivf_pregnancies, CASE ((k*380827+4398618)%1000003%2) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_di_pregnancies,
  CASE ((k*388745+4503347)%1000003%4) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_births, CASE ((k*396663+4608076)%1000003%3) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_ivf_births, CASE ((k*404581+4712805)%1000003%2) WHEN 0 THEN '0회' WHEN 1 THEN '1회' WHEN 2 THEN '2회' WHEN 3 THEN '3회' WHEN 4 THEN '4회' WHEN 5 THEN '5회' ELSE '6회 이상' END AS n_di_births,
  CASE WHEN NOT di THEN CAST(emb AS DOUBLE) END AS embryos_total,
  CASE WHEN NOT di THEN CAST(icsi AS DOUBLE) END AS icsi_eggs,
  CASE WHEN NOT di THEN CAST(icsi_emb AS DOUBLE) END AS icsi_embryos,
  CASE WHEN NOT di THEN CAST(trf AS DOUBLE) END AS embryos_transferred,
  CASE WHEN NOT di THEN CAST(CASE WHEN icsi>0 THEN trf ELSE 0 END AS DOUBLE) END AS icsi_transferred,
  CASE WHEN NOT di THEN CAST(CASE WHEN emb>trf THEN (emb-trf)%6 ELSE 0 END AS DOUBLE) END AS embryos_stored,
  CASE WHEN NOT di THEN CAST(CASE WHEN icsi>0 AND emb>trf THEN (emb-trf)%3 ELSE 0 END AS DOUBLE) END AS icsi_stored,
  CASE WHEN NOT di THEN CAST(thawed AS DOUBLE) END AS embryos_thawed,
  CASE WHEN NOT di THEN CAST(CASE WHEN ((k*412499+4817534)%1000003%150)=0 THEN 4 ELSE 0 END AS DOUBLE) END AS eggs_thawed,
  CASE WHEN NOT di THEN CAST(fresh AS DOUBLE) END AS fresh_eggs,
  CASE WHEN NOT di THEN CAST((((k*420417+4922263)%1000003%30)=29) AS INT)*3*1.0E0 END AS fresh_eggs_stored,
  CASE WHEN NOT di THEN CAST(mixed AS DOUBLE) END AS mixed_eggs,
  CASE WHEN NOT di THEN CAST(CASE WHEN ((k*428335+5026992)%1000003%8)=0 THEN 0 ELSE mixed END AS DOUBLE) END AS partner_mixed_eggs,
  CASE WHEN NOT di THEN CAST(CASE WHEN ((k*428335+5026992)%1000003%8)=0 THEN mixed ELSE 0 END AS DOUBLE) END AS donor_mixed_eggs,
  CASE WHEN di THEN '알 수 없음' WHEN ((k*436253+5131721)%1000003%15)=0 THEN '기증 제공' ELSE '본인 제공' END AS egg_source,
  CASE WHEN di OR ((k*428335+5026992)%1000003%8)=0 THEN '기증 제공' ELSE '배우자 제공' END AS sperm_source,
  CASE WHEN ((k*436253+5131721)%1000003%15)=0 AND NOT di THEN CASE ((k*444171+5236450)%1000003%6) WHEN 0 THEN '만20세 이하' WHEN 1 THEN '만21-25세' WHEN 2 THEN '만26-30세' WHEN 3 THEN '만31-35세' ELSE '알 수 없음' END ELSE '알 수 없음' END AS egg_donor_age,
  CASE WHEN di THEN CASE ((k*452089+5341179)%1000003%3) WHEN 0 THEN '만21-25세' WHEN 1 THEN '만36-40세' ELSE '만41-45세' END ELSE '알 수 없음' END AS sperm_donor_age,
  CASE WHEN NOT di THEN CAST(fet AS INT)*1.0E0 END AS frozen_embryo_used,
  CASE WHEN NOT di THEN CAST(NOT fet AS INT)*1.0E0 END AS fresh_embryo_used,
  CASE WHEN NOT di THEN CAST((((k*460007+5445908)%1000003%300)=0) AS INT)*1.0E0 END AS donor_embryo_used,
  CASE WHEN NOT di THEN CAST((((k*467925+5550637)%1000003%400)=0) AS INT)*1.0E0 END AS surrogate,
  CASE WHEN ((k*475843+5655366)%1000003%100)=0 THEN 1.0E0 END AS pgd, CASE WHEN ((k*483761+5760095)%1000003%120)=0 THEN 1.0E0 END AS pgs,
  CASE WHEN NOT di AND NOT fet THEN 0.0E0 END AS day_egg_pickup,
  CASE WHEN ((k*412499+4817534)%1000003%150)=0 AND NOT di THEN 0.0E0 END AS day_egg_thaw,
  CASE WHEN NOT di AND mixed>0 THEN CAST((((k*491679+5864824)%1000003%20)=19) AS INT)*1.0E0 END AS day_egg_mix,
  CASE WHEN NOT di AND trf>0 THEN CAST(CASE d5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 WHEN 6 THEN 3 ELSE 5 END AS DOUBLE) END AS day_transfer,
  CASE WHEN fet AND NOT di THEN CAST(((k*499597+5969553)%1000003%3) AS DOUBLE) END AS day_embryo_thaw,
  CASE WHEN ((k*507515+6074282)%1000003%100) < CASE WHEN di THEN 13 WHEN trf=0 THEN 2 WHEN d5>=7 THEN 40 WHEN ((k*135369+1152019)%1000003%40)%4=0 THEN 33 ELSE 22 END THEN 1 ELSE 0 END AS success,
  CASE WHEN ((k*515433+6179011)%1000003%5)=0 THEN 'test' ELSE 'train' END AS split
FROM s4
"""


def cycles_from(orders: DataFrame) -> DataFrame:
    """The 69 registry columns plus ``split``; row-local, so it also works on a stream."""
    spark: SparkSession = orders.sparkSession
    return spark.sql(CYCLES_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)


def read_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    return cycles_from(spread(orders, "o_orderkey"))
