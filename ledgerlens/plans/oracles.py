"""DuckDB statements that state the expected result of each registered query.

They read the same tables and use the fixture's column expressions; everything after that is
written independently of the Spark code."""

from __future__ import annotations

from ledgerlens.schemas import CATEGORICAL, GOLD, NUMERIC, SILVER, TRANSACTIONS
from ledgerlens.sources.fixture import CUSTOMER_COLUMNS, TABLES, TRANSACTION_COLUMNS

_TX_FIELDS = ", ".join(f'{sql} AS "{name}"' for name, sql in TRANSACTION_COLUMNS.items())
TX = f"""tx AS (SELECT {_TX_FIELDS} FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""
SILVER_CTE = f"""{TX},
timed AS (SELECT *, try_cast(concat(trans_date, ' ', trans_time) AS TIMESTAMP) AS event_time FROM tx),
silver AS (SELECT trans_num, sha256(CAST(cc_num AS VARCHAR)) AS customer_hash, event_time, amt,
  category, merchant, state, city_pop, gender, job,
  CAST(date_sub('year', CAST(dob AS TIMESTAMP), event_time) AS BIGINT) AS age,
  round(6371 * 2 * asin(sqrt(least(1.0e0, pow(sin((radians(merch_lat) - radians(lat)) / 2), 2)
    + cos(radians(lat)) * cos(radians(merch_lat))
      * pow(sin(radians(merch_long - long) / 2), 2)))), 2) AS distance_km,
  CAST(hour(event_time) AS INT) AS "hour", CAST(dayofweek(event_time) + 1 AS INT) AS day_of_week,
  CAST(month(event_time) AS INT) AS "month", is_fraud FROM timed)"""
CUT = """cut AS (SELECT quantile_disc(CAST(epoch(event_time) AS BIGINT), 0.8) AS corte FROM silver)"""
_HASH = "CAST('0x' || substr(sha256(trans_num), 1, 8) AS UBIGINT) / 4294967296.0e0"
_SECONDS = "CAST(epoch(event_time) AS BIGINT)"


def _gold(side: str, fraction: float, source: str = "silver") -> str:
    sign = "<" if side == "train" else ">="
    return f"""{side} AS (SELECT *, CASE WHEN is_fraud = 0 THEN {1 / fraction}e0 ELSE 1.0e0 END
  AS sample_weight FROM {source} WHERE {_SECONDS} {sign} (SELECT corte FROM cut)
  AND (is_fraud = 1 OR {_HASH} < {fraction}e0))"""


_REST = [c for c in SILVER.names if c not in ("trans_num", "event_time")]
DEDUP = f"""dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY trans_num
  ORDER BY event_time DESC NULLS LAST, {', '.join(f'"{c}" DESC NULLS LAST' for c in _REST)}) AS rn
  FROM silver) WHERE rn = 1)"""

SCORED = """scored AS (
  SELECT 'valor' AS modelo, round(amt / 1100.0e0, 2) AS p, is_fraud AS y,
    CASE WHEN is_fraud = 0 THEN 20.0e0 ELSE 1.0e0 END AS w FROM silver
  UNION ALL SELECT 'distancia', floor(distance_km / 1.5e0) / 100.0e0, is_fraud,
    CASE WHEN is_fraud = 0 THEN 20.0e0 ELSE 1.0e0 END FROM silver
  UNION ALL SELECT 'idade', age / 100.0e0, is_fraud,
    CASE WHEN is_fraud = 0 THEN 20.0e0 ELSE 1.0e0 END FROM silver
  UNION ALL SELECT 'mista', CASE WHEN is_fraud = 1 THEN 50 + CAST(floor(amt) AS BIGINT) % 47
    ELSE CAST(floor(amt) AS BIGINT) % 60 END / 100.0e0, is_fraud,
    CASE WHEN is_fraud = 0 THEN 20.0e0 ELSE 1.0e0 END FROM silver)"""
POINTS = f"""{SILVER_CTE}, {SCORED},
g AS (SELECT modelo, p, sum(w * y) AS tp, sum(w * (1 - y)) AS fp FROM scored GROUP BY 1, 2),
c AS (SELECT *, sum(tp) OVER d AS ctp, sum(fp) OVER d AS cfp,
  sum(tp) OVER m AS allp, sum(fp) OVER m AS alln FROM g
  WINDOW d AS (PARTITION BY modelo ORDER BY p DESC), m AS (PARTITION BY modelo)),
points AS (SELECT *, ctp / (ctp + cfp) AS prec, ctp / allp AS rec, cfp / alln AS fpr FROM c),
summary AS (SELECT modelo, sum(tp / allp * prec) AS pr_auc_w,
  sum(fp * ((ctp - tp) + tp / 2)) / max(allp) / max(alln) AS roc_auc_w,
  coalesce(max(CASE WHEN prec >= 0.9e0 THEN rec END), 0.0e0) AS recall_p90_w
  FROM points GROUP BY modelo),
f AS (SELECT *, 2 * prec * rec / greatest(prec + rec, 1e-12) AS f1 FROM points),
cutoffs AS (SELECT modelo, coalesce(min(CASE WHEN prec >= 0.9e0 THEN p END), 0.5e0) AS p90,
  (list(p ORDER BY f1 DESC, p ASC))[1] AS f1 FROM f GROUP BY modelo),
predicted AS (SELECT s.*, CAST(s.p >= t.f1 AS INT) AS pred FROM scored s JOIN cutoffs t USING (modelo)),
cells AS (SELECT modelo,
  sum(CASE WHEN y = 0 AND pred = 0 THEN w ELSE 0e0 END) AS c00,
  sum(CASE WHEN y = 0 AND pred = 1 THEN w ELSE 0e0 END) AS c01,
  sum(CASE WHEN y = 1 AND pred = 0 THEN w ELSE 0e0 END) AS c10,
  sum(CASE WHEN y = 1 AND pred = 1 THEN w ELSE 0e0 END) AS c11 FROM predicted GROUP BY modelo),
classes AS (
  SELECT modelo, 'legítima' AS classe, coalesce(c00 / nullif(c00 + c10, 0), 0) AS precisao,
    coalesce(c00 / nullif(c00 + c01, 0), 0) AS recall, c00 + c01 AS suporte, c00 + c11 AS hits FROM cells
  UNION ALL SELECT modelo, 'fraude', coalesce(c11 / nullif(c11 + c01, 0), 0),
    coalesce(c11 / nullif(c11 + c10, 0), 0), c10 + c11, c00 + c11 FROM cells),
perclass AS (SELECT modelo, classe, precisao, recall,
  coalesce(2 * precisao * recall / nullif(precisao + recall, 0), 0) AS f1, suporte, hits FROM classes)"""


def _silver(body: str) -> str:
    return f"WITH {SILVER_CTE} {body}"


def _points(body: str) -> str:
    return f"WITH {POINTS} {body}"


_PAIR_COLUMNS = ["amt", "age", "distance_km", "city_pop", "hour", "day_of_week", "month", "is_fraud"]
_CORR = " UNION ALL ".join(
    f"""SELECT '{a}' AS linha, '{b}' AS coluna, """
    + ("1.0e0" if a == b else f'round(corr("{a}", "{b}"), 9)')
    + " AS correlacao FROM silver"
    for a in _PAIR_COLUMNS
    for b in _PAIR_COLUMNS
    if a != b
)
_DIAGONAL = " UNION ALL ".join(
    f"SELECT '{a}' AS linha, '{a}' AS coluna, 1.0e0 AS correlacao" for a in _PAIR_COLUMNS
)
_TARGET_CORR = " UNION ALL ".join(
    f"""SELECT '{a}' AS coluna, round(corr("{a}", is_fraud), 9) AS correlacao FROM silver"""
    for a in _PAIR_COLUMNS
    if a != "is_fraud"
)
_NULLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS coluna, CAST(count(*) - count("{c}") AS BIGINT) AS nulos FROM silver"""
    for c in SILVER.names
)


def _describe(column: str, quantile: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    v = f'CAST("{column}" AS DOUBLE)'
    q = ", ".join(f"round({quantile}({v}, {p / 100}), 6) AS p{p}" for p in (25, 50, 75))
    return (
        f"SELECT {lead}'{column}' AS coluna, count({v}) AS n, round(avg({v}), 6) AS media,"
        f" round(stddev_samp({v}), 6) AS desvio, min({v}) AS minimo, max({v}) AS maximo, {q}"
        f" FROM silver{tail}"
    )


_CLASS = "CASE is_fraud WHEN 0 THEN 'legítima' WHEN 1 THEN 'fraude' END"
_LABELLED = f"labelled AS (SELECT {_CLASS} AS classe, amt, distance_km FROM silver)"
_RATE = 'count(*) AS n, round(avg(is_fraud), 9) AS taxa FROM silver GROUP BY 1'
_BANDS = """CASE WHEN amt < 10 THEN '1. até 10' WHEN amt < 50 THEN '2. 10 a 50'
  WHEN amt < 100 THEN '3. 50 a 100' WHEN amt < 250 THEN '4. 100 a 250'
  WHEN amt < 500 THEN '5. 250 a 500' WHEN amt < 1000 THEN '6. 500 a 1000'
  ELSE '7. acima de 1000' END"""
_PIVOT = ", ".join(
    f'round(avg(CASE WHEN "hour" = {h} THEN is_fraud END) * 100, 9) AS h{h:02d}' for h in range(24)
)
_MODELLING = f"{SILVER_CTE}, {DEDUP}, cut AS (SELECT quantile_disc({_SECONDS}, 0.8) AS corte FROM dedup), {_gold('train', 0.1, 'dedup')}, {_gold('test', 0.05, 'dedup')}"
_CODES = ", ".join(
    f"""coalesce((SELECT CAST(v.cod AS DOUBLE) FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1
  AS cod FROM (SELECT DISTINCT {c} FROM train)) v WHERE v.v = t.{c}), -1.0e0) AS {c}_cod"""
    for c in CATEGORICAL
)
_MOMENTS = "moments AS (SELECT " + ", ".join(
    f'avg("{c}") AS m_{c}, stddev_pop("{c}") AS s_{c}' for c in NUMERIC
)
_SCALED = ", ".join(
    f'round((t."{c}" - (SELECT m_{c} FROM moments)) / (SELECT s_{c} FROM moments), 9) AS {c}_pad'
    for c in NUMERIC
)
_UNSAMPLED = f"""before AS (SELECT * FROM silver WHERE {_SECONDS} < (SELECT corte FROM cut)),
after AS (SELECT * FROM silver WHERE {_SECONDS} >= (SELECT corte FROM cut))"""

_NEIGHBOUR_Z = ", ".join(
    f'("{c}" - (SELECT m_{c} FROM moments)) / (SELECT s_{c} FROM moments) AS z_{c}' for c in NUMERIC
)
_NEIGHBOUR_D2 = " + ".join(f"(a.z_{c} - b.z_{c}) * (a.z_{c} - b.z_{c})" for c in NUMERIC)
_NEIGHBOUR_CAT = " + ".join(f"CAST(a.{c} <> b.{c} AS INT)" for c in CATEGORICAL)
_IMPORTANCE = " UNION ALL ".join(
    f"""SELECT state AS modelo, '{c}' AS variavel,
  greatest(coalesce(covar_pop("{c}", is_fraud) / nullif(stddev_pop("{c}") * stddev_pop(is_fraud), 0), 0), 0)
  AS v FROM silver GROUP BY state"""
    for c in NUMERIC
)
_ONE_HOT_OFFSETS = {"category": "0", "state": "(SELECT count(DISTINCT category) FROM train)",
                    "gender": "(SELECT count(DISTINCT category) + count(DISTINCT state) FROM train)"}
_ONE_HOT_LEVELS = "(SELECT count(DISTINCT category) + count(DISTINCT state) + count(DISTINCT gender) FROM train)"
_ONE_HOT = " UNION ALL ".join(
    [
        f"""SELECT CAST({off} + k.cod AS INT) AS posicao, round(CAST(count(t.{c}) AS DOUBLE), 6) AS soma
  FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS cod FROM (SELECT DISTINCT {c} FROM train)) k
  LEFT JOIN test t ON t.{c} = k.v GROUP BY 1"""
        for c, off in _ONE_HOT_OFFSETS.items()
    ]
    + [
        f"""SELECT CAST({_ONE_HOT_LEVELS} + {i} AS INT), round(sum(("{c}" - (SELECT m_{c} FROM moments))
  / (SELECT s_{c} FROM moments)), 6) FROM test"""
        for i, c in enumerate(NUMERIC)
    ]
)
_SUMMARY_ROUNDED = """modelo, round(pr_auc_w, 9) AS pr_auc_w, round(roc_auc_w, 9) AS roc_auc_w,
  round(recall_p90_w, 9) AS recall_p90_w"""
_ROUNDS = """r AS (SELECT max(CASE WHEN modelo = 'valor' THEN pr_auc_w END) AS a,
  max(CASE WHEN modelo = 'distancia' THEN pr_auc_w END) AS b,
  max(CASE WHEN modelo = 'idade' THEN pr_auc_w END) AS c FROM summary)"""

_TX_LIST = ", ".join(f'"{c}"' for c in TRANSACTIONS.names)
_CUSTOMER_FIELDS = ", ".join(
    f'{sql.format(k="c.c_custkey")} AS "{name}"' for name, sql in CUSTOMER_COLUMNS.items()
)
_FULL_SILVER = _silver("SELECT * FROM silver")
_RATE_CATEGORY_SQL = """SELECT category, count(*) AS transacoes, CAST(sum(is_fraud) AS BIGINT) AS fraudes,
  round(avg(is_fraud) * 100, 3) AS taxa_fraude_pct FROM silver GROUP BY category"""

_LEARNERS = {
    "model_logreg": ["regressao_logistica"],
    "model_tree": ["arvore_decisao"],
    "model_forest": ["random_forest"],
    "model_gbt": ["lightgbm", "xgboost", "hist_gradient_boosting"],
    "model_gbt_depth": ["xgboost"],
    "model_gbt_hist": ["hist_gradient_boosting"],
    "model_adaboost": ["adaboost"],
}
_INFERRED = ", ".join(
    f"({i}, '{name}', '{kind}')"
    for i, (name, kind) in enumerate(
        zip(
            CUSTOMER_COLUMNS,
            "string bigint string string string string string string int double double int"
            " string date bigint string".split(),
        )
    )
)

ORACLES: dict[str, str] = {
    "ingest_transactions_csv": f"WITH {TX} SELECT {_TX_LIST} FROM tx",
    "ingest_customers_csv": f"""SELECT {_CUSTOMER_FIELDS} FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "table_roundtrip": _FULL_SILVER,
    "sql_fraud_rate_by_category": _silver(_RATE_CATEGORY_SQL),
    "range_source": """SELECT CAST(max(o_orderkey) - min(o_orderkey) + 1 AS BIGINT) AS n_faixa,
        count(DISTINCT o_orderkey) AS n_presentes,
        CAST(max(o_orderkey) - min(o_orderkey) + 1 - count(DISTINCT o_orderkey) AS BIGINT) AS n_ausentes
        FROM orders""",
    "missing_files": """SELECT DISTINCT 'transactions_' || strftime(l_shipdate, '%Y-%m') || '.csv' AS arquivo
        FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') NOT IN
        (SELECT strftime(o_orderdate, '%Y-%m') FROM orders)""",
    "infer_schema_profile": f"""SELECT v.*, n AS preenchidos, 0::BIGINT AS nulos
        FROM (VALUES {_INFERRED}) v(posicao, coluna, tipo),
        (SELECT count(*) AS n FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "peek_rows": """SELECT least(1000, count(*))::BIGINT AS linhas,
        least(1000, count(*))::BIGINT AS conhecidas FROM lineitem""",
    "file_inventory": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS arquivo, count(*) AS linhas FROM {t}" for t in TABLES
    ),
    "approx_distinct_ids": _silver("""SELECT count(DISTINCT trans_num) AS ids_distintos,
        count(*) AS linhas, true AS dentro_do_limite FROM silver"""),
    "smotenc_repeated_ids": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.1)},
        c AS (SELECT count(*) FILTER (is_fraud = 0) AS legit, count(*) FILTER (is_fraud = 1) AS fraud FROM train)
        SELECT 0 AS is_fraud, false AS sintetico, legit AS n FROM c
        UNION ALL SELECT 1, false, fraud FROM c
        UNION ALL SELECT 1, true, CAST(floor(0.5e0 * legit) AS BIGINT) - fraud FROM c
          WHERE floor(0.5e0 * legit) > fraud""",
    "smotenc": f"""WITH {_MODELLING},
        c AS (SELECT count(*) FILTER (is_fraud = 0) AS legit, count(*) FILTER (is_fraud = 1) AS fraud FROM train)
        SELECT 0 AS is_fraud, false AS sintetico, legit AS n, true AS dentro FROM c
        UNION ALL SELECT 1, false, fraud, true FROM c
        UNION ALL SELECT 1, true, CAST(floor(0.5e0 * legit) AS BIGINT) - fraud, true FROM c
          WHERE floor(0.5e0 * legit) > fraud""",
    **{
        name: f"""WITH {_MODELLING} SELECT modelo, count(*) AS linhas, count(*) FILTER (is_fraud = 1) AS fraudes,
          true AS probabilidades, true AS roc_acima_do_acaso, true AS pr_acima_do_acaso
          FROM test, (VALUES {', '.join(f"('{m}')" for m in learners)}) v(modelo) GROUP BY modelo"""
        for name, learners in _LEARNERS.items()
    },
    "score_batch": f"""WITH {_MODELLING} SELECT trans_num, 0.5e0 AS limiar, true AS probabilidade,
        true AS decisao_coerente FROM test""",
    "stream_score": f"""WITH {_MODELLING} SELECT category, state, gender, amt, city_pop,
        CAST(age AS DOUBLE) AS age, distance_km, "hour", day_of_week, "month", 0.5e0 AS limiar,
        true AS probabilidade, true AS decisao_coerente FROM test""",
    "permutation_importance": "SELECT *, true AS no_intervalo, true AS alguma_positiva FROM (VALUES "
    + ", ".join(f"('{c}')" for c in [*CATEGORICAL, *NUMERIC])
    + ") v(variavel)",
    "retrain_summary": """SELECT * FROM (VALUES (1, true, false, true), (2, false, true, true))
        v(rodada, promovido, havia_campeao, area_valida)""",
    "compare_models": f"""WITH {_MODELLING}
        SELECT modelo, true AS registrado, true AS medido, true AS acima_do_acaso,
          (SELECT count(*) FROM test) AS linhas_pontuadas, 10::BIGINT AS variaveis
        FROM (VALUES {', '.join(f"('{m}')" for m in dict.fromkeys(m for learners in _LEARNERS.values() for m in learners))}) v(modelo)""",
    "stream_bronze": f"WITH {TX} SELECT {_TX_LIST} FROM tx",
    "stream_rejected": f"""WITH {_MODELLING}
        SELECT CASE CAST(split_part(trans_num, '-', 1) AS BIGINT) % 10 WHEN 3 THEN 'missing or mistyped: amt'
          WHEN 7 THEN 'not json' ELSE 'answered' END AS fim, count(*) AS n FROM test GROUP BY 1""",
    "metrics_sink": _points(f"SELECT {_SUMMARY_ROUNDED} FROM summary"),
    "append_history": _points(f""", {_ROUNDS},
        h AS (SELECT 'r1' AS data, a AS pr_auc_desafiante, CAST(NULL AS DOUBLE) AS pr_auc_atual, true AS promovido FROM r
        UNION ALL SELECT 'r2', b, a, b > a + 0.002e0 FROM r
        UNION ALL SELECT 'r3', c, CASE WHEN b > a + 0.002e0 THEN b ELSE a END,
          c > CASE WHEN b > a + 0.002e0 THEN b ELSE a END + 0.002e0 FROM r)
        SELECT data, round(pr_auc_desafiante, 9) AS pr_auc_desafiante,
          round(pr_auc_atual, 9) AS pr_auc_atual, promovido FROM h"""),
    "run_log": _points("""SELECT modelo || '_pontuacao' AS run, modelo, 'nenhum' AS balanceamento,
        round(pr_auc_w, 9) AS pr_auc_w, round(roc_auc_w, 9) AS roc_auc_w FROM summary"""),
    "parse_event_time": _silver("SELECT trans_num, amt, event_time FROM silver"),
    "hash_pii": _silver("SELECT trans_num, amt, customer_hash FROM silver"),
    "age_at_event": _silver("SELECT trans_num, event_time, amt, age FROM silver"),
    "haversine_km": _silver("SELECT trans_num, amt, distance_km FROM silver"),
    "calendar_features": _silver(
        'SELECT trans_num, amt, "hour" AS hour, day_of_week, "month" AS month FROM silver'
    ),
    "silver_transactions": _FULL_SILVER,
    "epoch_seconds": _silver(f"SELECT trans_num, amt, {_SECONDS} AS event_ts FROM silver"),
    "sample_weights": _silver("""SELECT trans_num, amt, is_fraud,
        CASE WHEN is_fraud = 0 THEN 50.0e0 ELSE 1.0e0 END AS sample_weight FROM silver"""),
    "class_label": _silver(f"SELECT trans_num, amt, is_fraud, {_CLASS} AS classe FROM silver"),
    "target_distribution": _silver(f"""SELECT is_fraud, count(*) AS n, {_CLASS} AS classe,
        round(count(*) * 100.0e0 / sum(count(*)) OVER (), 9) AS pct FROM silver GROUP BY is_fraud"""),
    "time_split": f"""WITH {SILVER_CTE}, {CUT}, {_UNSAMPLED}
        SELECT 'train' AS parte, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS fraudes,
          min(event_time) AS inicio, max(event_time) AS fim FROM before
        UNION ALL SELECT 'test', count(*), CAST(sum(is_fraud) AS BIGINT), min(event_time), max(event_time) FROM after""",
    "fraud_count_by_table": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}, {_gold('test', 0.05)}
        SELECT 'silver' AS tabela, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS fraudes FROM silver
        UNION ALL SELECT 'train', count(*), CAST(sum(is_fraud) AS BIGINT) FROM train
        UNION ALL SELECT 'test', count(*), CAST(sum(is_fraud) AS BIGINT) FROM test""",
    "apply_threshold": _silver("""SELECT trans_num, p, CAST(p >= 0.5e0 AS INT) AS pred
        FROM (SELECT trans_num, round(amt / 1100.0e0, 2) AS p FROM silver)"""),
    "row_count": _silver("SELECT count(*) AS n FROM silver"),
    "class_balance": _silver("SELECT is_fraud, count(*) AS n FROM silver GROUP BY is_fraud"),
    "null_audit": _silver(_NULLS),
    "time_range": _silver("SELECT min(event_time) AS inicio, max(event_time) AS fim FROM silver"),
    "distinct_ids": _silver(
        "SELECT count(DISTINCT trans_num) AS ids_distintos, count(*) AS linhas FROM silver"
    ),
    "duplicate_ids": _silver("""SELECT count(*) AS ids_duplicados FROM
        (SELECT trans_num FROM silver GROUP BY trans_num HAVING count(*) > 1)"""),
    "dedup_latest": f"WITH {SILVER_CTE}, {DEDUP} SELECT * FROM dedup",
    "numeric_summary": _silver(
        " UNION ALL ".join(
            _describe(c, "quantile_disc") for c in ("amt", "age", "distance_km", "city_pop")
        )
    ),
    "rate_by_category": _silver("""SELECT category, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS fraudes,
        round(avg(is_fraud), 9) AS taxa FROM silver GROUP BY category"""),
    "rate_by_amount_band": _silver(f"SELECT {_BANDS} AS faixa, {_RATE}"),
    "rate_by_hour": _silver(f'SELECT "hour" AS hour, {_RATE}'),
    "rate_by_age_decade": _silver(f"SELECT CAST(age // 10 * 10 AS BIGINT) AS faixa_idade, {_RATE}"),
    "rate_by_state": _silver(f"SELECT state, {_RATE}"),
    "monthly_fraud": _silver("""SELECT CAST(date_trunc('month', event_time) AS TIMESTAMP) AS mes, count(*) AS n,
        CAST(sum(is_fraud) AS BIGINT) AS fraudes, round(avg(is_fraud), 9) AS taxa FROM silver GROUP BY 1"""),
    "dow_hour_pivot": _silver(f"SELECT day_of_week, {_PIVOT} FROM silver GROUP BY day_of_week"),
    "rate_by_band_period": _silver("""SELECT CASE WHEN amt < 50 THEN '1. até 50' WHEN amt < 250 THEN '2. 50 a 250'
        WHEN amt < 1000 THEN '3. 250 a 1000' ELSE '4. acima de 1000' END AS faixa_valor,
        CASE WHEN "hour" < 6 THEN 'madrugada' WHEN "hour" < 12 THEN 'manhã'
        WHEN "hour" < 18 THEN 'tarde' ELSE 'noite' END AS periodo,
        count(*) AS transacoes, round(avg(is_fraud) * 100, 3) AS taxa_fraude_pct FROM silver GROUP BY 1, 2"""),
    "top_merchants": _silver("""SELECT merchant, count(*) AS transacoes, CAST(sum(is_fraud) AS BIGINT) AS fraudes,
        round(avg(is_fraud) * 100, 2) AS taxa_fraude_pct FROM silver GROUP BY merchant
        HAVING count(*) >= 600 ORDER BY taxa_fraude_pct DESC, merchant LIMIT 15"""),
    "top_fraud_customers": _silver("""SELECT customer_hash, count(*) AS transacoes,
        CAST(sum(is_fraud) AS BIGINT) AS fraudes,
        round(sum(CASE WHEN is_fraud = 1 THEN amt ELSE 0 END), 2) AS valor_fraudado FROM silver
        GROUP BY customer_hash HAVING sum(is_fraud) > 0 ORDER BY fraudes DESC, customer_hash LIMIT 20"""),
    "overall_rate": _silver("""SELECT round(avg(is_fraud) * 100, 9) AS taxa_media,
        round(CAST(sum(is_fraud) AS DOUBLE) / count(*) * 100, 9) AS taxa_razao FROM silver"""),
    "imbalance_ratio": _silver("""SELECT count(*) FILTER (is_fraud = 0) AS legitimas,
        count(*) FILTER (is_fraud = 1) AS fraudes,
        round(CAST(count(*) FILTER (is_fraud = 0) AS DOUBLE) / count(*) FILTER (is_fraud = 1), 9) AS razao
        FROM silver"""),
    "correlation_matrix": _silver(f"{_CORR} UNION ALL {_DIAGONAL}"),
    "target_correlation": _silver(_TARGET_CORR),
    "describe_by_class": f"WITH {SILVER_CTE}, {_LABELLED} "
    + " UNION ALL ".join(
        _describe(c, "quantile_cont", "classe").replace("FROM silver", "FROM labelled")
        for c in ("amt", "distance_km")
    ),
    "log_histogram": f"""WITH {SILVER_CTE}, {_LABELLED},
        span AS (SELECT ln(greatest(min(amt), 0.01e0)) AS lo, ln(max(amt)) AS hi FROM silver),
        binned AS (SELECT classe, CAST(least(greatest(floor(49 * (ln(amt) - lo) / (hi - lo)), 0), 48) AS BIGINT) AS bin,
          lo, (hi - lo) / 49 AS step FROM labelled, span WHERE amt >= exp(lo) - 1e-12),
        counts AS (SELECT classe, bin, any_value(exp(lo + bin * step)) AS inicio,
          any_value(exp(lo + (bin + 1) * step)) AS fim, count(*) AS n FROM binned GROUP BY classe, bin)
        SELECT classe, bin, round(inicio, 6) AS inicio, round(fim, 6) AS fim, n,
          round(n / (sum(n) OVER (PARTITION BY classe) * (fim - inicio)), 9) AS densidade FROM counts""",
    "linear_histogram": f"""WITH {SILVER_CTE}, {_LABELLED},
        span AS (SELECT classe, min(distance_km) AS lo, max(distance_km) AS hi FROM labelled GROUP BY classe),
        binned AS (SELECT classe, CAST(least(floor(50 * (distance_km - lo) / (hi - lo)), 49) AS BIGINT) AS bin,
          lo, (hi - lo) / 50 AS step FROM labelled JOIN span USING (classe)),
        counts AS (SELECT classe, bin, any_value(lo + bin * step) AS inicio,
          any_value(lo + (bin + 1) * step) AS fim, count(*) AS n FROM binned GROUP BY classe, bin)
        SELECT classe, bin, round(inicio, 6) AS inicio, round(fim, 6) AS fim, n,
          round(n / (sum(n) OVER (PARTITION BY classe) * (fim - inicio)), 9) AS densidade FROM counts""",
    "reconcile_layers": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}, {_gold('test', 0.05)},
        t AS (SELECT (SELECT CAST(sum(is_fraud) AS BIGINT) FROM silver) AS fraudes_bronze,
          (SELECT CAST(sum(is_fraud) AS BIGINT) FROM train) + (SELECT CAST(sum(is_fraud) AS BIGINT) FROM test) AS fraudes_gold,
          (SELECT CAST(count(*) FILTER (is_fraud = 0) AS DOUBLE) FROM silver) AS legitimas_bronze,
          (SELECT sum(sample_weight) FILTER (is_fraud = 0) FROM train)
            + (SELECT sum(sample_weight) FILTER (is_fraud = 0) FROM test) AS legitimas_restauradas,
          (SELECT max({_SECONDS}) FROM train) < (SELECT corte FROM cut)
            AND (SELECT min({_SECONDS}) FROM test) >= (SELECT corte FROM cut) AS sem_sobreposicao)
        SELECT *, fraudes_bronze = fraudes_gold AS fraudes_ok,
          abs(legitimas_restauradas - legitimas_bronze) <= 0.05e0 * legitimas_bronze AS legitimas_ok FROM t""",
    "top_states": _silver(f"SELECT state, {_RATE} ORDER BY taxa DESC, state LIMIT 15"),
    "top_models": _points(
        "SELECT modelo, round(pr_auc_w, 9) AS pr_auc_w FROM summary ORDER BY pr_auc_w DESC, modelo LIMIT 3"
    ),
    "best_model": _points("""SELECT modelo, round(f1, 9) AS f1 FROM perclass WHERE classe = 'fraude'
        ORDER BY f1 DESC, modelo LIMIT 1"""),
    "time_cutoff": f"WITH {SILVER_CTE}, {CUT} SELECT CAST(corte AS BIGINT) AS corte FROM cut",
    "stratified_sample": _silver(
        f"SELECT * FROM silver WHERE is_fraud = 1 OR {_HASH} < 0.006e0"
    ),
    "gold_train": f"WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)} SELECT * FROM train",
    "gold_test": f"WITH {SILVER_CTE}, {CUT}, {_gold('test', 0.05)} SELECT * FROM test",
    "fixed_n_sample": f"""WITH {SILVER_CTE}, {CUT}, {_UNSAMPLED}
        SELECT * FROM after ORDER BY sha256(trans_num), trans_num, {', '.join(f'"{c}"' for c in SILVER.names if c != 'trans_num')}
        LIMIT 1000""",
    "smotenc_neighbors": f"""WITH {SILVER_CTE}, {DEDUP}, {_MOMENTS} FROM dedup),
        pts AS (SELECT trans_num, {', '.join(CATEGORICAL)}, {_NEIGHBOUR_Z} FROM dedup WHERE is_fraud = 1),
        dev AS (SELECT median(s) AS med FROM ({' UNION ALL '.join(f'SELECT stddev_pop(z_{c}) AS s FROM pts' for c in NUMERIC)})),
        pairs AS (SELECT a.trans_num AS id, b.trans_num AS vizinho, {_NEIGHBOUR_D2}
          + (SELECT med * med FROM dev) * ({_NEIGHBOUR_CAT}) AS d2
          FROM pts a JOIN pts b ON a.trans_num <> b.trans_num),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d2, 9), vizinho) AS posicao FROM pairs)
        SELECT id, CAST(posicao AS INT) AS posicao, vizinho, round(sqrt(d2), 6) AS distancia FROM ranked WHERE posicao <= 5""",
    "balance_before_after": f"""WITH {_MODELLING}
        SELECT is_fraud, count(*) AS antes, CASE WHEN is_fraud = 0 THEN count(*) ELSE greatest(count(*),
          CAST(floor(0.5e0 * (SELECT count(*) FROM train WHERE is_fraud = 0)) AS BIGINT)) END AS depois
        FROM train GROUP BY is_fraud""",
    "class_proportion": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}
        SELECT is_fraud, round(count(*) / sum(count(*)) OVER (), 4) AS proporcao FROM train GROUP BY is_fraud""",
    "ordinal_encode": f"WITH {_MODELLING} SELECT t.trans_num, {_CODES} FROM test t",
    "standard_scale": f"WITH {_MODELLING}, {_MOMENTS} FROM train) SELECT t.trans_num, {_SCALED} FROM test t",
    "one_hot": f"WITH {_MODELLING}, {_MOMENTS} FROM train) {_ONE_HOT}",
    "feature_vector": f"WITH {_MODELLING}, {_MOMENTS} FROM train) SELECT t.trans_num, {_CODES}, {_SCALED} FROM test t",
    "pr_curve": _points("""SELECT modelo, p AS limiar, round(prec, 9) AS precisao, round(rec, 9) AS recall FROM points
        UNION ALL SELECT DISTINCT modelo, CAST(NULL AS DOUBLE), 1.0e0, 0.0e0 FROM points"""),
    "average_precision": _points("SELECT modelo, round(pr_auc_w, 9) AS pr_auc_w FROM summary"),
    "roc_curve": _points("""SELECT modelo, p AS limiar, round(fpr, 9) AS fpr, round(rec, 9) AS tpr FROM points
        UNION ALL SELECT DISTINCT modelo, CAST(NULL AS DOUBLE), 0.0e0, 0.0e0 FROM points"""),
    "roc_auc": _points("SELECT modelo, round(roc_auc_w, 9) AS roc_auc_w FROM summary"),
    "recall_at_p90": _points("SELECT modelo, round(recall_p90_w, 9) AS recall_p90_w FROM summary"),
    "choose_thresholds": _points("SELECT modelo, p90, f1 FROM cutoffs"),
    "classification_report": _points(""", rows AS (
        SELECT modelo, classe, precisao, recall, f1, suporte FROM perclass
        UNION ALL SELECT modelo, 'accuracy', max(hits) / sum(suporte), max(hits) / sum(suporte),
          max(hits) / sum(suporte), sum(suporte) FROM perclass GROUP BY modelo
        UNION ALL SELECT modelo, 'macro avg', avg(precisao), avg(recall), avg(f1), sum(suporte) FROM perclass GROUP BY modelo
        UNION ALL SELECT modelo, 'weighted avg', sum(precisao * suporte) / sum(suporte),
          sum(recall * suporte) / sum(suporte), sum(f1 * suporte) / sum(suporte), sum(suporte) FROM perclass GROUP BY modelo)
        SELECT modelo, classe, round(precisao, 9) AS precisao, round(recall, 9) AS recall, round(f1, 9) AS f1, suporte FROM rows"""),
    "fraud_class_summary": _points("""SELECT f.modelo, round(f.precisao, 9) AS precisao, round(f.recall, 9) AS recall,
        round(f.f1, 9) AS f1, round(1 - l.recall, 9) AS alarme_falso
        FROM perclass f JOIN perclass l ON f.modelo = l.modelo AND f.classe = 'fraude' AND l.classe = 'legítima'"""),
    "confusion_matrix": _points("""SELECT modelo, 0 AS real, 0 AS previsto, c00 AS peso, round(c00 * 100 / (c00 + c01), 9) AS pct FROM cells
        UNION ALL SELECT modelo, 0, 1, c01, round(c01 * 100 / (c00 + c01), 9) FROM cells
        UNION ALL SELECT modelo, 1, 0, c10, round(c10 * 100 / (c10 + c11), 9) FROM cells
        UNION ALL SELECT modelo, 1, 1, c11, round(c11 * 100 / (c10 + c11), 9) FROM cells"""),
    "no_skill_rate": f"WITH {SILVER_CTE}, {SCORED} SELECT round(sum(y * w) / sum(w), 9) AS taxa_real FROM scored WHERE modelo = 'valor'",
    "mean_importance": f"""WITH {SILVER_CTE}, imp AS ({_IMPORTANCE}),
        scaled AS (SELECT variavel, v / nullif(sum(v) OVER (PARTITION BY modelo), 0) AS v FROM imp)
        SELECT variavel, round(avg(v), 9) AS media FROM scaled GROUP BY variavel""",
    "score_agreement": f"WITH {_MODELLING} SELECT count(*) AS n, 0.0e0 AS maior_diferenca, true AS iguais FROM test",
    "promote_if_better": _points(f""", {_ROUNDS} SELECT round(b, 9) AS pr_auc_desafiante,
        round(a, 9) AS pr_auc_atual, b > a + 0.002e0 AS promovido FROM r"""),
    "stream_silver": _FULL_SILVER,
    "stream_dedup": f"""WITH {TX}, timed AS (SELECT *, try_cast(concat(trans_date, ' ', trans_time) AS TIMESTAMP) AS event_time
        FROM (SELECT DISTINCT {_TX_LIST} FROM tx)), {SILVER_CTE[SILVER_CTE.index("silver AS ("):]} SELECT * FROM silver""",
    "stream_monthly": f"""WITH {TX},
        timed AS (SELECT *, try_cast(concat(trans_date, ' ', trans_time) AS TIMESTAMP) AS event_time, row_id % 20 = 0 AS late FROM tx),
        edge AS (SELECT max(event_time) - INTERVAL 31 DAY AS edge FROM timed WHERE NOT late)
        SELECT CAST(date_trunc('month', event_time) AS TIMESTAMP) AS mes, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS fraudes,
          round(avg(is_fraud), 9) AS taxa, count(*) FILTER (late AND event_time < edge) AS atrasadas
        FROM timed, edge GROUP BY 1""",
    "sketch_cutoff": _silver("SELECT count(*) AS linhas, true AS dentro_do_erro FROM silver"),
    "sketch_distinct": _silver("""SELECT count(DISTINCT trans_num) AS ids_distintos, count(*) AS linhas,
        true AS linhas_iguais, true AS dentro_do_limite FROM silver"""),
    "sketch_returning": _silver("""SELECT event_month, count(*) FILTER (event_month < ultimo) AS ids, true AS dentro_do_limite
        FROM (SELECT DISTINCT trans_num, strftime(event_time, '%Y-%m') AS event_month FROM silver)
        JOIN (SELECT trans_num, strftime(max(event_time), '%Y-%m') AS ultimo FROM silver GROUP BY 1) USING (trans_num)
        GROUP BY 1"""),
    "ingest_rejected": f"""WITH {TX}, ended AS (SELECT amt, concat_ws(',', CASE WHEN row_id % 70 = 5 THEN 'unix_time' END,
          CASE WHEN row_id % 50 = 3 THEN 'amt' END) AS bad FROM tx)
        SELECT CASE WHEN bad = '' THEN 'aceita' ELSE bad END AS fim, count(*) AS n,
          round(sum(CASE WHEN bad = '' THEN amt END), 2) AS valor FROM ended GROUP BY 1""",
    "etl_incremental": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}, {_gold('test', 0.05)}, every AS (
        SELECT 'silver' AS parte, *, CAST(NULL AS DOUBLE) AS sample_weight FROM silver
        UNION ALL SELECT 'train' AS parte, * FROM train UNION ALL SELECT 'test' AS parte, * FROM test)
        SELECT *, CAST(0 AS BIGINT) AS novos FROM every""",
    "customer_history": _silver("""SELECT customer_hash, trans_num, event_time, amt, category, merchant, is_fraud,
        row_number() OVER (ORDER BY event_time, trans_num) AS ordem FROM silver
        WHERE customer_hash = (SELECT customer_hash FROM silver GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""),
    "etl_audit": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}, {_gold('test', 0.05)}, """
    + ", ".join(
        f"""a_{t} AS (SELECT '{t}' AS tabela, count(*) AS n, count(*) FILTER (is_fraud = 1) AS fraudes,
          count(*) FILTER (is_fraud = 0) AS legitimas, min(event_time) AS inicio, max(event_time) AS fim FROM {t})"""
        for t in ("silver", "train", "test")
    )
    + " "
    + " UNION ALL ".join(
        f"""SELECT a_{t}.*, '{c}' AS coluna, (SELECT count(*) FROM {t} WHERE "{c}" IS NULL) AS nulos FROM a_{t}"""
        for t, names in (("silver", SILVER.names), ("train", GOLD.names), ("test", GOLD.names))
        for c in names
    ),
    "etl_silver": _FULL_SILVER,
    "etl_gold": f"""WITH {SILVER_CTE}, {CUT}, {_gold('train', 0.02)}, {_gold('test', 0.05)}
        SELECT 'train' AS parte, * FROM train UNION ALL SELECT 'test' AS parte, * FROM test""",
}
