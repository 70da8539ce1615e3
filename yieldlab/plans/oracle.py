"""Independent DuckDB SQL for every checked query (the correctness oracle).

The adapters below mirror ``adapters.py`` expression by expression; each
query is an ordinary SQL statement over the pre-registered test tables.
Sums of integers are cast to BIGINT, literals are doubles, and ranks are
INTEGER so that types match the Spark side.
"""

from __future__ import annotations

# ---- adapters -------------------------------------------------------------

PRED = """SELECT event_id AS Wafer_ID, ts AS Timestamp,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Actual_Result,
  CASE WHEN value >= 120 THEN 1 ELSE 0 END AS Predicted_Class,
  value / (value + 50.0) AS Failure_Probability
FROM events"""

PLOGS = """SELECT event_id AS Wafer_ID, ts AS Timestamp,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Label
FROM events"""

EMB_CELLS = """SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos
FROM embeddings"""

SENSORS = f"""SELECT vec_id AS unit_no, CAST(pos + 1 AS INTEGER) AS sensor_no,
  CASE WHEN pos % 16 = 0 THEN CAST(1.0 AS DOUBLE)
       WHEN (vec_id * 7 + pos * 13) % 100 < pos THEN NULL
       ELSE CAST(v AS DOUBLE) END AS value
FROM ({EMB_CELLS})"""

UNIT_META = """SELECT vec_id AS unit_no,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(vec_id * 27 AS BIGINT)) AS Timestamp,
  CASE WHEN label = 0 THEN 1 ELSE 0 END AS Label
FROM embeddings"""

ATTR = f"""SELECT vec_id AS Wafer_ID, CAST(pos + 1 AS INTEGER) AS sensor_no,
  'Sensor_' || CAST(pos + 1 AS VARCHAR) AS Sensor_Name, CAST(v AS DOUBLE) AS SHAP_Value
FROM ({EMB_CELLS})"""

RCA = f"""SELECT a.Wafer_ID, e.ts AS Timestamp, a.Sensor_Name, a.SHAP_Value,
  CAST(a.rk AS INTEGER) AS Rank
FROM (SELECT *, row_number() OVER (PARTITION BY Wafer_ID
        ORDER BY abs(SHAP_Value) DESC, sensor_no, SHAP_Value) AS rk
      FROM ({ATTR})) a
JOIN events e ON e.event_id = a.Wafer_ID
WHERE a.rk <= 3"""

ORDERS_PRED = """SELECT o_orderkey AS Wafer_ID, o_orderdate AS Timestamp,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS Actual_Result,
  CASE WHEN o_totalprice >= 450000.0 THEN 1 ELSE 0 END AS Predicted_Class,
  o_totalprice / (o_totalprice + 100000.0) AS Failure_Probability
FROM orders"""

ORDERS_PLOGS = """SELECT o_orderkey AS Wafer_ID, o_orderdate AS Timestamp,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS Label
FROM orders"""

LINE_ATTR = """SELECT l_orderkey AS Wafer_ID, l_suppkey AS sensor_no,
  'Sensor_' || CAST(l_suppkey AS VARCHAR) AS Sensor_Name,
  (l_discount - 0.05) * l_quantity AS SHAP_Value
FROM lineitem"""


def top3_rca(attr_sql: str, pred_sql: str) -> str:
    """A2: top-3 |value| per predicted-fail unit, value rounded to 6."""
    return f"""SELECT Wafer_ID, Timestamp, Sensor_Name, ROUND(SHAP_Value, 6) AS SHAP_Value,
  CAST(rk AS INTEGER) AS Rank
FROM (SELECT a.*, p.Timestamp, row_number() OVER (PARTITION BY a.Wafer_ID
        ORDER BY abs(a.SHAP_Value) DESC, a.sensor_no, a.SHAP_Value) AS rk
      FROM ({attr_sql}) a JOIN ({pred_sql}) p ON a.Wafer_ID = p.Wafer_ID
      WHERE p.Predicted_Class = 1) t
WHERE rk <= 3"""


ORDERS_RCA = top3_rca(LINE_ATTR, ORDERS_PRED)


def with_(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items())
    return f"WITH {parts}\n{body}"


# ---- views ------------------------------------------------------------------

YIELD_KPIS_BODY = """SELECT CAST(Timestamp AS DATE) AS Production_Date,
  COUNT(DISTINCT Wafer_ID) AS Total_Wafers,
  CAST(SUM(Actual_Result) AS BIGINT) AS Actual_Failures,
  ROUND(CAST(100.0 AS DOUBLE) * SUM(Actual_Result) / NULLIF(COUNT(Wafer_ID), 0), 2)
    AS Actual_Defect_Rate_Pct,
  CAST(SUM(Predicted_Class) AS BIGINT) AS Predicted_Failures,
  ROUND(CAST(100.0 AS DOUBLE) * SUM(Predicted_Class) / NULLIF(COUNT(Wafer_ID), 0), 2)
    AS Predicted_Defect_Rate_Pct,
  ROUND(AVG(CASE WHEN Predicted_Class = 1 THEN Failure_Probability END), 4)
    AS Avg_Failure_Probability
FROM p GROUP BY CAST(Timestamp AS DATE)"""

HIGH_RISK_BODY = """SELECT Sensor_Name,
  COUNT(DISTINCT Wafer_ID) AS Affected_Wafers,
  ROUND(AVG(ABS(SHAP_Value)), 6) AS Avg_Abs_SHAP,
  ROUND(MAX(ABS(SHAP_Value)), 6) AS Max_Abs_SHAP,
  ROUND(SUM(ABS(SHAP_Value)), 6) AS Total_SHAP_Impact,
  COUNT(*) AS Total_Appearances,
  CAST(RANK() OVER (ORDER BY SUM(ABS(SHAP_Value)) DESC) AS INTEGER) AS Impact_Rank
FROM r
WHERE CAST(Timestamp AS DATE) >= CAST((SELECT MAX(Timestamp) FROM r) AS DATE) - 7
GROUP BY Sensor_Name"""

STABILITY_BODY = """SELECT pl.Wafer_ID, pl.Timestamp, CAST(pl.Timestamp AS DATE) AS Production_Date,
  mp.Predicted_Class, mp.Failure_Probability, mp.Actual_Result,
  ts.Sensor_Name AS Monitored_Sensor,
  ROUND(AVG(mp.Failure_Probability) OVER w, 4) AS Rolling5_Avg_Fail_Prob,
  ROUND(SQRT(GREATEST(
      AVG(mp.Failure_Probability * mp.Failure_Probability) OVER w
      - AVG(mp.Failure_Probability) OVER w * AVG(mp.Failure_Probability) OVER w,
      CAST(0.0 AS DOUBLE))), 6) AS Rolling5_StdDev_Fail_Prob
FROM pl JOIN mp ON pl.Wafer_ID = mp.Wafer_ID
CROSS JOIN (SELECT Sensor_Name FROM r GROUP BY Sensor_Name
            ORDER BY SUM(ABS(SHAP_Value)) DESC, Sensor_Name LIMIT 1) ts
WINDOW w AS (ORDER BY pl.Timestamp, pl.Wafer_ID ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""

DETAIL_BODY = """SELECT mp.Wafer_ID, mp.Timestamp, mp.Actual_Result, mp.Predicted_Class,
  mp.Failure_Probability, r.Sensor_Name, r.SHAP_Value, r.Rank AS Sensor_Rank,
  CASE WHEN r.SHAP_Value > 0 THEN 'Pushes Toward Fail' ELSE 'Pushes Toward Pass' END
    AS SHAP_Direction
FROM mp LEFT JOIN r ON mp.Wafer_ID = r.Wafer_ID
WHERE mp.Predicted_Class = 1"""

TOP_SENSOR_BODY = """SELECT Sensor_Name, ROUND(SUM(ABS(SHAP_Value)), 6) AS Total_Abs_SHAP
FROM r GROUP BY Sensor_Name ORDER BY SUM(ABS(SHAP_Value)) DESC, Sensor_Name LIMIT 1"""

RECURRING_BODY = """SELECT Sensor_Name, COUNT(*) AS Appearances, ROUND(AVG(SHAP_Value), 9) AS Mean_SHAP
FROM r GROUP BY Sensor_Name ORDER BY Appearances DESC, Sensor_Name LIMIT 10"""


ORACLE: dict[str, str] = {
    "yield_kpis": with_(YIELD_KPIS_BODY, p=PRED),
    "yield_kpis_orders": with_(YIELD_KPIS_BODY, p=ORDERS_PRED),
    "high_risk_sensors": with_(HIGH_RISK_BODY, r=RCA),
    "high_risk_sensors_orders": with_(HIGH_RISK_BODY, r=ORDERS_RCA),
    "process_stability": with_(STABILITY_BODY, pl=PLOGS, mp=PRED, r=RCA),
    "process_stability_orders": with_(
        STABILITY_BODY, pl=ORDERS_PLOGS, mp=ORDERS_PRED, r=ORDERS_RCA
    ),
    "failure_detail": with_(DETAIL_BODY, mp=PRED, r=RCA),
    "failure_detail_orders": with_(DETAIL_BODY, mp=ORDERS_PRED, r=ORDERS_RCA),
    "top_sensor": with_(TOP_SENSOR_BODY, r=RCA),
    "recurring_sensors": with_(RECURRING_BODY, r=RCA),
    "top_sensors_per_failure": top3_rca(ATTR, PRED),
    "top_sensors_per_failure_orders": ORDERS_RCA,
}


# ---- cleaning ---------------------------------------------------------------

MEDIANS = """SELECT sensor_no, (MIN(value) + MAX(value)) / CAST(2.0 AS DOUBLE) AS median
FROM (SELECT sensor_no, value,
        row_number() OVER (PARTITION BY sensor_no ORDER BY value, unit_no) - 1 AS rn,
        COUNT(*) OVER (PARTITION BY sensor_no) AS c
      FROM {src} WHERE value IS NOT NULL) q
WHERE rn = (c - 1) // 2 OR rn = c // 2
GROUP BY sensor_no"""

KEPT = """SELECT sensor_no FROM s GROUP BY sensor_no
HAVING COUNT_IF(value IS NULL) / COUNT(*) <= 0.5"""

LINE_SENSORS = """SELECT l_orderkey AS unit_no, CAST(l_linenumber AS INTEGER) AS sensor_no,
  CASE WHEN l_linenumber = 6 AND l_quantity > 10 THEN NULL
       WHEN l_quantity > 45 THEN NULL
       WHEN l_linenumber = 7 THEN CAST(1.0 AS DOUBLE)
       ELSE l_extendedprice END AS value
FROM lineitem"""


def clean_sql(src: str) -> str:
    """The cleaning chain (drop sparse, exact medians, drop constant) over
    the long readings produced by ``src``."""
    return with_(
        """SELECT s.unit_no, s.sensor_no, COALESCE(s.value, med.median) AS value
FROM s JOIN keep2 USING (sensor_no) LEFT JOIN med USING (sensor_no)""",
        s=src,
        kept=KEPT,
        ks="SELECT * FROM s WHERE sensor_no IN (SELECT sensor_no FROM kept)",
        med=MEDIANS.format(src="ks"),
        st="""SELECT sensor_no, COUNT(*) AS nr, COUNT(value) AS n, MIN(value) AS lo, MAX(value) AS hi
FROM ks GROUP BY sensor_no""",
        keep2="SELECT sensor_no FROM st WHERE NOT (n >= 1 AND nr >= 2 AND lo = hi)",
    )


CLEAN = clean_sql(SENSORS)
# The sensors that cleaning keeps: position % 16 = 0 is constant, above 50 mostly missing.
KEPT_NAMES = ", ".join(f"'Sensor_{pos + 1}'" for pos in range(51) if pos % 16)

SPLIT = """SELECT *, CAST(FLOOR(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS te,
  CAST(FLOOR(CAST(FLOOR(n * CAST(0.8 AS DOUBLE)) AS BIGINT) * CAST(0.9 AS DOUBLE)) AS BIGINT) AS fe
FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS i, COUNT(*) OVER () AS n
      FROM {src}) q"""


def curve(src: str) -> dict:
    """CTEs of the PR sweep over table ``src`` (Failure_Probability, Actual_Result)."""
    return dict(
        g=f"""SELECT Failure_Probability AS threshold, COUNT_IF(Actual_Result = 1) AS pos,
  COUNT_IF(NOT (Actual_Result = 1)) AS neg FROM {src} GROUP BY 1""",
        c="""SELECT threshold,
  SUM(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  SUM(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  (SELECT SUM(pos) FROM g) AS P FROM g""",
        k="""SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CASE WHEN tp + fp = 0 THEN CAST(0.0 AS DOUBLE) ELSE tp / (tp + fp) END AS precision,
  CASE WHEN P = 0 THEN CAST(1.0 AS DOUBLE) ELSE tp / P END AS recall FROM c""",
        curve="""SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM k""",
    )


BUILT = dict(
    p=PRED,
    sp=SPLIT.format(order="Timestamp, Wafer_ID", src="p"),
    t="SELECT * FROM sp WHERE i >= te",
    **curve("t"),
    b="SELECT threshold FROM curve ORDER BY f1 DESC, threshold LIMIT 1",
    bp="""SELECT Wafer_ID, Timestamp, Actual_Result,
  CASE WHEN Failure_Probability >= b.threshold THEN 1 ELSE 0 END AS Predicted_Class,
  ROUND(Failure_Probability, 6) AS Failure_Probability FROM t, b""",
)

REPORT_BODY = """SELECT 'Pass' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM f
UNION ALL SELECT 'Fail', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL,
  CASE WHEN tot = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(hits AS DOUBLE) / CAST(tot AS DOUBLE) END, tot FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / CAST(2.0 AS DOUBLE), (r0 + r1) / CAST(2.0 AS DOUBLE),
  (f0 + f1) / CAST(2.0 AS DOUBLE), tot FROM f
UNION ALL SELECT 'weighted avg',
  CASE WHEN tot = 0 THEN CAST(0.0 AS DOUBLE) ELSE (p0 * s0 + p1 * s1) / CAST(tot AS DOUBLE) END,
  CASE WHEN tot = 0 THEN CAST(0.0 AS DOUBLE) ELSE (r0 * s0 + r1 * s1) / CAST(tot AS DOUBLE) END,
  CASE WHEN tot = 0 THEN CAST(0.0 AS DOUBLE) ELSE (f0 * s0 + f1 * s1) / CAST(tot AS DOUBLE) END,
  tot FROM f"""


def _ratio(num: str, den: str) -> str:
    return (f"CASE WHEN {den} = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END")


REPORT = dict(
    BUILT,
    kc="""SELECT COUNT_IF(Actual_Result = 0 AND Predicted_Class = 0) AS n00,
  COUNT_IF(Actual_Result = 0 AND Predicted_Class = 1) AS n01,
  COUNT_IF(Actual_Result = 1 AND Predicted_Class = 0) AS n10,
  COUNT_IF(Actual_Result = 1 AND Predicted_Class = 1) AS n11 FROM bp""",
    r=f"""SELECT {_ratio('n00', 'n00 + n10')} AS p0, {_ratio('n00', 'n00 + n01')} AS r0,
  {_ratio('n11', 'n11 + n01')} AS p1, {_ratio('n11', 'n11 + n10')} AS r1,
  n00 + n01 AS s0, n10 + n11 AS s1, n00 + n11 AS hits FROM kc""",
    f="""SELECT *,
  CASE WHEN p0 + r0 = 0 THEN CAST(0.0 AS DOUBLE) ELSE 2.0::DOUBLE * p0 * r0 / (p0 + r0) END AS f0,
  CASE WHEN p1 + r1 = 0 THEN CAST(0.0 AS DOUBLE) ELSE 2.0::DOUBLE * p1 * r1 / (p1 + r1) END AS f1,
  s0 + s1 AS tot FROM r""",
)

QTABLES = dict(
    pl="SELECT unit_no AS Wafer_ID, Timestamp, Label FROM (" + UNIT_META + ") u",
    mp=PRED,
    r=RCA,
)

ORACLE.update(
    {
        "sensor_missing_fraction": with_(
            """SELECT sensor_no, COUNT(*) AS n_rows, COUNT_IF(value IS NULL) AS n_missing,
  COUNT_IF(value IS NULL) / COUNT(*) AS missing_fraction FROM s GROUP BY sensor_no""",
            s=SENSORS,
        ),
        "drop_high_missing": with_(
            "SELECT * FROM s WHERE sensor_no IN (SELECT sensor_no FROM kept)", s=SENSORS, kept=KEPT
        ),
        "impute_median": with_(
            """SELECT s.unit_no, s.sensor_no, COALESCE(s.value, med.median) AS value
FROM s LEFT JOIN med USING (sensor_no)""",
            s=SENSORS,
            med=MEDIANS.format(src="s"),
        ),
        "drop_zero_variance": with_(
            """SELECT * FROM s WHERE sensor_no NOT IN (SELECT sensor_no FROM s GROUP BY sensor_no
  HAVING COUNT(value) >= 2 AND MIN(value) = MAX(value))""",
            s=SENSORS,
        ),
        "clean_sensors": CLEAN,
        "remaining_missing": f"SELECT COUNT_IF(value IS NULL) AS remaining_missing FROM ({CLEAN}) c",
        "top_variance_sensors": f"""SELECT sensor_no, ROUND(var_samp(value), 12) AS variance
FROM ({CLEAN}) c GROUP BY sensor_no HAVING var_samp(value) IS NOT NULL
ORDER BY var_samp(value) DESC, sensor_no LIMIT 20""",
        "control_limits": with_(
            """SELECT st.sensor_no, st.n_readings, ROUND(m, 9) AS mean, ROUND(sd, 9) AS std,
  ROUND(m - CAST(3.0 AS DOUBLE) * sd, 9) AS lower_limit,
  ROUND(m + CAST(3.0 AS DOUBLE) * sd, 9) AS upper_limit,
  COALESCE(o.n_out, 0) AS n_out_of_limits
FROM st LEFT JOIN (
  SELECT c.sensor_no, COUNT_IF(c.value < st.m - CAST(3.0 AS DOUBLE) * st.sd
                            OR c.value > st.m + CAST(3.0 AS DOUBLE) * st.sd) AS n_out
  FROM c JOIN st USING (sensor_no) GROUP BY c.sensor_no) o USING (sensor_no)""",
            c=CLEAN,
            st="""SELECT sensor_no, COUNT(value) AS n_readings, AVG(value) AS m,
  STDDEV_SAMP(value) AS sd FROM c GROUP BY sensor_no""",
        ),
        "production_logs": f"""PIVOT (
  SELECT printf('WAFER_%04d', c.unit_no + 1) AS Wafer_ID, m.Timestamp, m.Label,
         'Sensor_' || CAST(c.sensor_no AS VARCHAR) AS sname, c.value
  FROM ({CLEAN}) c JOIN ({UNIT_META}) m USING (unit_no)
) ON sname IN ({KEPT_NAMES}) USING first(value) GROUP BY Wafer_ID, Timestamp, Label""",
        "assign_unit_id": """SELECT vec_id AS unit_no,
  printf('WAFER_%04d', row_number() OVER (ORDER BY vec_id)) AS Wafer_ID FROM embeddings""",
        "fill_timestamps": with_(
            """SELECT Wafer_ID, COALESCE(
  LAST_VALUE(Timestamp IGNORE NULLS) OVER (ORDER BY Wafer_ID
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  FIRST_VALUE(Timestamp IGNORE NULLS) OVER (ORDER BY Wafer_ID
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS Timestamp FROM g""",
            g=f"""SELECT Wafer_ID, CASE WHEN Wafer_ID % 7 < 2 THEN NULL ELSE Timestamp END AS Timestamp
FROM ({PRED}) p""",
        ),
        "even_time_axis": """SELECT vec_id AS unit_no,
  TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST(
    (CAST(row_number() OVER (ORDER BY vec_id) - 1 AS HUGEINT) * 2592000000000)
      // (COUNT(*) OVER () - 1) AS BIGINT)) AS Timestamp
FROM embeddings""",
        "time_split": with_(
            """SELECT Wafer_ID, i AS Split_Index,
  CASE WHEN i < fe THEN 'train' WHEN i < te THEN 'validation' ELSE 'test' END AS Split FROM sp""",
            p=PRED,
            sp=SPLIT.format(order="Timestamp, Wafer_ID", src="p"),
        ),
        "label_summary": f"""SELECT COUNT(*) AS n_rows, CAST(SUM(Actual_Result) AS BIGINT) AS n_fail,
  COUNT_IF(Actual_Result != 1) AS n_pass,
  ROUND(CAST(100.0 AS DOUBLE) * AVG(CAST(Actual_Result AS DOUBLE)), 4) AS failure_rate_pct,
  MIN(Timestamp) AS first_time, MAX(Timestamp) AS last_time FROM ({PRED}) p""",
        "class_weight": with_(
            """SELECT COUNT_IF(Actual_Result = 0) AS n_neg, COUNT_IF(Actual_Result = 1) AS n_pos,
  CAST(COUNT_IF(Actual_Result = 0) AS DOUBLE)
    / CAST(GREATEST(COUNT_IF(Actual_Result = 1), 1) AS DOUBLE) AS scale_pos_weight
FROM sp WHERE i < te""",
            p=PRED,
            sp=SPLIT.format(order="Timestamp, Wafer_ID", src="p"),
        ),
        "pr_curve": with_("SELECT * FROM curve", p=PRED, **curve("p")),
        "best_f1_threshold": with_(
            "SELECT threshold, precision, recall, f1 FROM curve ORDER BY f1 DESC, threshold LIMIT 1",
            p=PRED,
            **curve("p"),
        ),
        "roc_auc": with_(
            """SELECT CAST(P AS BIGINT) AS n_pos, CAST(N AS BIGINT) AS n_neg,
  CASE WHEN P = 0 OR N = 0 THEN NULL
       ELSE CAST(U2 AS DOUBLE) / (CAST(2 AS DOUBLE) * CAST(P AS DOUBLE) * CAST(N AS DOUBLE))
  END AS roc_auc FROM t""",
            p=PRED,
            g="""SELECT Failure_Probability AS s, COUNT_IF(Actual_Result = 1) AS pos,
  COUNT_IF(NOT (Actual_Result = 1)) AS neg FROM p GROUP BY 1""",
            c="""SELECT s, pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM g""",
            t="SELECT SUM(pos) AS P, SUM(neg) AS N, SUM(pos * (2 * neg_below + neg)) AS U2 FROM c",
        ),
        "build_predictions": with_("SELECT * FROM bp", **BUILT),
        "confusion_matrix": with_(
            """SELECT a.Actual, q.Predicted, COUNT(bp.Wafer_ID) AS n
FROM (VALUES (0), (1)) a(Actual) CROSS JOIN (VALUES (0), (1)) q(Predicted)
LEFT JOIN bp ON bp.Actual_Result = a.Actual AND bp.Predicted_Class = q.Predicted
GROUP BY a.Actual, q.Predicted""",
            **BUILT,
        ),
        "classification_report": with_(REPORT_BODY, **REPORT),
        "table_row_counts": with_(
            """SELECT 'production_logs' AS table_name, COUNT(*) AS n_rows FROM pl
UNION ALL SELECT 'ml_predictions', COUNT(*) FROM mp
UNION ALL SELECT 'root_cause_analysis', COUNT(*) FROM r""",
            **QTABLES,
        ),
        "key_violations": with_(
            """SELECT 'production_logs' AS table_name, 'duplicate_key' AS check_name,
  COUNT(*) - COUNT(DISTINCT Wafer_ID) AS n_violations FROM pl
UNION ALL SELECT 'production_logs', 'null_Wafer_ID', COUNT_IF(Wafer_ID IS NULL) FROM pl
UNION ALL SELECT 'production_logs', 'null_Timestamp', COUNT_IF(Timestamp IS NULL) FROM pl
UNION ALL SELECT 'production_logs', 'null_Label', COUNT_IF(Label IS NULL) FROM pl
UNION ALL SELECT 'ml_predictions', 'duplicate_key', COUNT(*) - COUNT(DISTINCT Wafer_ID) FROM mp
UNION ALL SELECT 'ml_predictions', 'null_Wafer_ID', COUNT_IF(Wafer_ID IS NULL) FROM mp
UNION ALL SELECT 'root_cause_analysis', 'duplicate_key',
  COUNT(*) - COUNT(DISTINCT (Wafer_ID, Rank)) FROM r
UNION ALL SELECT 'root_cause_analysis', 'null_Wafer_ID', COUNT_IF(Wafer_ID IS NULL) FROM r
UNION ALL SELECT 'root_cause_analysis', 'null_Sensor_Name', COUNT_IF(Sensor_Name IS NULL) FROM r
UNION ALL SELECT 'root_cause_analysis', 'null_SHAP_Value', COUNT_IF(SHAP_Value IS NULL) FROM r
UNION ALL SELECT 'root_cause_analysis', 'null_Rank', COUNT_IF(Rank IS NULL) FROM r""",
            **QTABLES,
        ),
        "orphan_rows": with_(
            """SELECT 'ml_predictions' AS table_name, COUNT(*) AS n_orphans FROM mp
  WHERE NOT EXISTS (SELECT 1 FROM pl WHERE pl.Wafer_ID = mp.Wafer_ID)
UNION ALL SELECT 'root_cause_analysis', COUNT(*) FROM r
  WHERE NOT EXISTS (SELECT 1 FROM pl WHERE pl.Wafer_ID = r.Wafer_ID)""",
            **QTABLES,
        ),
        "select_scored_units": with_(
            "SELECT * FROM s WHERE unit_no IN (SELECT unit_no FROM sp WHERE i >= te)",
            s=SENSORS,
            u=UNIT_META,
            sp=SPLIT.format(order="Timestamp, unit_no", src="u"),
        ),
        "attach_labels": f"""SELECT s.unit_no, s.sensor_no, s.value, m.Timestamp, m.Label
FROM ({SENSORS}) s JOIN ({UNIT_META}) m ON s.unit_no = m.unit_no""",
        "rolling_mean": """SELECT event_id, ROUND(AVG(value) OVER w, 6) AS rolling_mean FROM events
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
        "rolling_std": """SELECT event_id, ROUND(SQRT(GREATEST(AVG(value * value) OVER w
  - AVG(value) OVER w * AVG(value) OVER w, CAST(0.0 AS DOUBLE))), 6) AS rolling_std FROM events
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
        "load_sensor_text": SENSORS,
        "parse_label_lines": f"""SELECT Wafer_ID,
  CASE WHEN Wafer_ID % 11 = 0 THEN 0 ELSE Actual_Result END AS Label,
  CASE WHEN Wafer_ID % 13 = 0 THEN NULL ELSE date_trunc('second', Timestamp) END AS Timestamp
FROM ({PRED}) p""",
        "linear_attribution": with_(
            """SELECT unit_no, sensor_no,
  ROUND(((sensor_no % 5) - 2) / CAST(10.0 AS DOUBLE) * (value - mu), 9)
    + CAST(0.0 AS DOUBLE) AS attribution
FROM c JOIN m USING (sensor_no)""",
            c=CLEAN,
            m="SELECT sensor_no, AVG(value) AS mu FROM c GROUP BY sensor_no",
        ),
        "global_importance": with_(
            """SELECT Sensor_Name, ROUND(SUM(ABS(SHAP_Value)) / CAST(
  (SELECT COUNT(DISTINCT Wafer_ID) FROM a) AS DOUBLE), 9) AS Mean_Abs_SHAP
FROM a GROUP BY Sensor_Name
ORDER BY SUM(ABS(SHAP_Value)) / CAST((SELECT COUNT(DISTINCT Wafer_ID) FROM a) AS DOUBLE) DESC,
  Sensor_Name LIMIT 20""",
            a=ATTR,
        ),
        "unit_waterfall": with_(
            """SELECT Wafer_ID, Position, Feature, ROUND(SHAP_Value, 9) AS SHAP_Value,
  ROUND(CAST(0.0 AS DOUBLE) + SUM(SHAP_Value) OVER (PARTITION BY Wafer_ID ORDER BY Position DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS Cumulative FROM w""",
            a=ATTR,
            rk="""SELECT *, row_number() OVER (PARTITION BY Wafer_ID
  ORDER BY abs(SHAP_Value) DESC, sensor_no, SHAP_Value) AS rk FROM a""",
            w="""SELECT Wafer_ID, CAST(rk AS INTEGER) AS Position, Sensor_Name AS Feature, SHAP_Value
FROM rk WHERE rk <= 14
UNION ALL SELECT Wafer_ID, 15, printf('%d other features', COUNT(*)), SUM(SHAP_Value)
FROM rk WHERE rk > 14 GROUP BY Wafer_ID""",
        ),
    }
)



ORACLE.update(
    {
        "sensor_separation": with_(
            """SELECT sensor_no, n_pass, n_fail,
  ROUND((m1 - m0) / NULLIF(SQRT(v0) + SQRT(v1), 0), 9) AS s2n,
  ROUND((m1 - m0) / NULLIF(SQRT(v0 / n_pass + v1 / n_fail), 0), 9) AS welch_t,
  ROUND(r, 9) AS pearson_r,
  ROUND((n_pass * (m0 - g) * (m0 - g) + n_fail * (m1 - g) * (m1 - g))
        / NULLIF(((n_pass - 1.0) * v0 + (n_fail - 1.0) * v1) / (n_pass + n_fail - 2.0), 0), 9) AS f_stat
FROM (SELECT *, (n_pass * m0 + n_fail * m1) / (n_pass + n_fail) AS g FROM a) q""",
            c=CLEAN,
            j=f"""SELECT c.unit_no, c.sensor_no, c.value, m.Label FROM c JOIN ({UNIT_META}) m USING (unit_no)
UNION ALL SELECT unit_no, 0, CAST(Label * 4 + 1 AS DOUBLE), Label FROM ({UNIT_META}) m""",
            a="""SELECT sensor_no,
  COUNT(value) FILTER (WHERE Label = 0) AS n_pass,
  COUNT(value) FILTER (WHERE Label = 1) AS n_fail,
  AVG(value) FILTER (WHERE Label = 0) AS m0,
  AVG(value) FILTER (WHERE Label = 1) AS m1,
  VAR_SAMP(value) FILTER (WHERE Label = 0) AS v0,
  VAR_SAMP(value) FILTER (WHERE Label = 1) AS v1,
  CORR(value, CAST(Label AS DOUBLE)) AS r
FROM j WHERE value IS NOT NULL GROUP BY sensor_no""",
        ),
        "balanced_error_rate": with_(
            """SELECT (CASE WHEN n00 + n01 = 0 THEN CAST(0.0 AS DOUBLE)
                 ELSE CAST(n01 AS DOUBLE) / CAST(n00 + n01 AS DOUBLE) END
          + CASE WHEN n10 + n11 = 0 THEN CAST(0.0 AS DOUBLE)
                 ELSE CAST(n10 AS DOUBLE) / CAST(n10 + n11 AS DOUBLE) END)
         / CAST(2.0 AS DOUBLE) AS balanced_error_rate FROM kc""",
            **REPORT,
        ),
    }
)


ORACLE["clean_sensors_lineitem"] = clean_sql(LINE_SENSORS)


def _bigint_counts(sql: str) -> str:
    """DuckDB's COUNT_IF is HUGEINT; Spark's is BIGINT. Cast every call."""
    out, i, key = [], 0, "COUNT_IF("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


ORACLE = {k: _bigint_counts(v) for k, v in ORACLE.items()}

_TEST_UNITS = dict(
    u="SELECT printf('WAFER_%04d', unit_no + 1) AS Wafer_ID, unit_no, Timestamp, Label FROM (" + UNIT_META + ") m",
    sp=SPLIT.format(order="Timestamp, unit_no", src="u"),
)

# Of the trained model, what holds whatever its trees are: a row for each test
# unit, probabilities, classes by the threshold, and attributions that add up.
ORACLE.update(
    {
        "train_score_gbt": with_(
            """SELECT Wafer_ID, Timestamp, CAST(Label AS INTEGER) AS Actual_Result,
  TRUE AS Is_Probability, TRUE AS Class_Agrees FROM sp WHERE i >= te""",
            **_TEST_UNITS,
        ),
        "tree_attribution": with_(
            "SELECT Wafer_ID, CAST(0.0 AS DOUBLE) AS Residual FROM sp WHERE i >= te", **_TEST_UNITS
        ),
        "stream_yield_kpis": with_(YIELD_KPIS_BODY, p=PRED),
    }
)

# ---- one tree of the regularised trainer, level by level ----------------------


def _tree_level(k: int, rows: str) -> str:
    """Best split of each node of ``rows`` (node, rid, g, h); L1 0.1, L2 1, hessian at least 5."""
    shrunk = "(SIGN({g}) * GREATEST(ABS({g}) - 0.1, 0.0))"
    part = lambda g, h: f"({shrunk.format(g=g)} * {shrunk.format(g=g)} / ({h} + 1.0))"
    return f"""c{k} AS (SELECT node, f, v, SUM(g) AS g, SUM(h) AS h FROM {rows} JOIN cells USING (rid) GROUP BY node, f, v),
t{k} AS (SELECT node, f, SUM(g) AS tg, SUM(h) AS th, COALESCE(SUM(g) FILTER (WHERE v IS NULL), 0) AS mg,
  COALESCE(SUM(h) FILTER (WHERE v IS NULL), 0) AS mh FROM c{k} GROUP BY node, f),
u{k} AS (SELECT node, f, v, SUM(g) OVER w AS lg, SUM(h) OVER w AS lh FROM c{k} WHERE v IS NOT NULL
  WINDOW w AS (PARTITION BY node, f ORDER BY v)),
d{k} AS (SELECT node, f, v, miss, tg, th, lg + CASE WHEN miss THEN mg ELSE 0 END AS gl, lh + CASE WHEN miss THEN mh ELSE 0 END AS hl
  FROM u{k} JOIN t{k} USING (node, f), (VALUES (FALSE), (TRUE)) AS m(miss)),
b{k} AS (SELECT *, {part("gl", "hl")} + {part("(tg - gl)", "(th - hl)")} - {part("tg", "th")} AS gain FROM d{k}
  WHERE hl >= 5 AND th - hl >= 5 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, miss, v) = 1)"""


_LEAF = "-0.05 * SIGN({g}) * GREATEST(ABS({g}) - 0.1, 0.0) / ({h} + 1.0)"

ORACLE["boosted_tree_splits"] = f"""WITH base AS (
  SELECT row_number() OVER () AS rid, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS q, l_discount AS d, l_tax AS t,
    CAST(l_linenumber AS DOUBLE) AS l, CASE WHEN l_extendedprice > 60000 THEN 1 ELSE 0 END AS y FROM lineitem),
cells AS (SELECT rid, 0 AS f, q AS v FROM base UNION ALL SELECT rid, 1, d FROM base
  UNION ALL SELECT rid, 2, t FROM base UNION ALL SELECT rid, 3, l FROM base),
s0 AS (SELECT 0 AS node, rid, CASE WHEN y = 1 THEN -1.5::DOUBLE ELSE 0.5::DOUBLE END AS g, CASE WHEN y = 1 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS h FROM base),
{_tree_level(0, "s0")},
s1 AS (SELECT CASE WHEN COALESCE(cells.v <= b0.v, b0.miss) THEN 1 ELSE 2 END AS node, rid, g, h
  FROM s0 JOIN cells USING (rid) JOIN b0 ON b0.f = cells.f),
{_tree_level(1, "s1")},
splits AS (SELECT * FROM b0 UNION ALL SELECT * FROM b1),
leaves AS (SELECT 2 * node + 1 AS node, gl AS g, hl AS h FROM b1 UNION ALL SELECT 2 * node + 2, tg - gl, th - hl FROM b1)
SELECT CAST(node AS INTEGER) AS node, ['quantity', 'discount', 'tax', 'line'][f + 1] AS feature_name, ROUND(v, 6) AS threshold, miss AS missing_left,
  ROUND(gain, 6) AS gain, ROUND(th, 6) AS cover, ROUND(tg, 6) AS grad, CAST(NULL AS DOUBLE) AS leaf_value FROM splits
UNION ALL SELECT CAST(node AS INTEGER), NULL, NULL, NULL, NULL, ROUND(h, 6), ROUND(g, 6), ROUND({_LEAF.format(g="g", h="h")}, 9) FROM leaves"""

ORACLE["state_yield_kpis"] = ORACLE["stream_yield_kpis"]
ORACLE["stream_process_stability"] = ORACLE["process_stability"]
ORACLE |= {f"live_{k}": ORACLE[k] for k in ("yield_kpis", "high_risk_sensors", "process_stability")}


PROBABILITIES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)

ORACLE["sensor_quantiles"] = with_(
    """SELECT sensor_no, CAST(p AS DOUBLE) AS p, n_readings, n_missing, lowest, highest, TRUE AS within
FROM (SELECT sensor_no, COUNT(value) AS n_readings, COUNT(*) - COUNT(value) AS n_missing,
    MIN(value) AS lowest, MAX(value) AS highest FROM s GROUP BY sensor_no),
  (SELECT unnest([%s]) AS p)""" % ", ".join(map(str, PROBABILITIES)),
    s=SENSORS,
)

ORACLE["load_violations"] = with_(
    """SELECT t AS table_name, c AS check_name, CAST(n AS BIGINT) AS n FROM (
SELECT 'production_logs' AS t, unnest(['n_rows', 'n_read', 'null_Wafer_ID', 'null_Timestamp', 'null_Label', 'duplicate_key']) AS c,
  unnest([COUNT(*), COUNT(*), COUNT(*) - COUNT(Wafer_ID), COUNT(*) - COUNT(Timestamp), COUNT(*) - COUNT(Label),
    COUNT(Wafer_ID) - COUNT(DISTINCT Wafer_ID)]) AS n FROM pl
UNION ALL SELECT 'ml_predictions', unnest(['n_rows', 'n_read', 'null_Wafer_ID', 'broken_probability', 'broken_class', 'duplicate_key', 'orphan']),
  unnest([COUNT(*), COUNT(*), COUNT(*) - COUNT(Wafer_ID), COUNT(*) FILTER (Failure_Probability < 0 OR Failure_Probability > 1),
    COUNT(*) FILTER ((Predicted_Class = 1) <> (Failure_Probability >= 0.8)), COUNT(Wafer_ID) - COUNT(DISTINCT Wafer_ID),
    COUNT(*) FILTER (Wafer_ID NOT IN (SELECT Wafer_ID FROM pl WHERE Wafer_ID IS NOT NULL))]) FROM mp
UNION ALL SELECT 'root_cause_analysis',
  unnest(['n_rows', 'n_read', 'null_Wafer_ID', 'null_Sensor_Name', 'null_SHAP_Value', 'null_Rank', 'broken_rank', 'duplicate_key', 'orphan']),
  unnest([COUNT(*), COUNT(*), COUNT(*) - COUNT(Wafer_ID), COUNT(*) - COUNT(Sensor_Name), COUNT(*) - COUNT(SHAP_Value), COUNT(*) - COUNT(Rank),
    COUNT(*) FILTER (Rank > 2), COUNT(Wafer_ID) - COUNT(DISTINCT Wafer_ID),
    COUNT(*) FILTER (Wafer_ID NOT IN (SELECT Wafer_ID FROM pl WHERE Wafer_ID IS NOT NULL))]) FROM r)""",
    pl=PLOGS,
    mp=ORDERS_PRED,
    r=RCA,
)

ORACLE["reloaded_yield_kpis"] = ORACLE["yield_kpis"]

ORACLE["load_sensor_csv"] = with_(
    """SELECT unit_no, sensor_no, unit_no % 17 = 0 OR unit_no % 19 = 0 AS is_bad,
  CASE WHEN unit_no % 19 = 0 AND sensor_no = 1 THEN NULL ELSE value END AS value FROM s""",
    s=SENSORS,
)

ORACLE["selection_errors"] = with_(
    """SELECT method, COUNT(*) FILTER (Label = 0) AS n_pass, COUNT(*) FILTER (Label = 1) AS n_fail,
  TRUE AS errors_agree, TRUE AS selected_distinct
FROM u, (SELECT unnest(['s2n', 'ttest', 'pearson', 'ftest', 'gram_schmidt']) AS method) GROUP BY method""",
    u=UNIT_META,
)
