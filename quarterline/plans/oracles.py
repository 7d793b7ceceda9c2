"""DuckDB SQL that states the same results as the registered queries, independently."""

from __future__ import annotations

from quarterline.functions.text import WHITE_SPACE
from quarterline.plans.queries import HOT_COMPANY
from quarterline.schema import MART_PAYLOAD, OBSERVATION_MATERIAL


def _double_text(v: str) -> str:
    """A double as the JVM writes it."""
    t = f"CAST(abs({v}) AS VARCHAR)"
    whole, part = f"split_part(split_part({t}, 'e', 1), '.', 1)", f"split_part(split_part({t}, 'e', 1), '.', 2)"
    digits = f"({whole} || {part})"
    power = f"coalesce(TRY_CAST(split_part({t}, 'e', 2) AS INTEGER), 0)"
    exponent = f"(length({whole}) - 1 - (length({digits}) - length(ltrim({digits}, '0'))) + {power})"
    used = f"rtrim(ltrim({digits}, '0'), '0')"
    sign = f"CASE WHEN {v} < 0 THEN '-' ELSE '' END"
    return f"""CASE WHEN isnan({v}) THEN 'NaN' WHEN isinf({v}) THEN {sign} || 'Infinity'
        WHEN {v} = 0 OR (abs({v}) >= 1e-3 AND abs({v}) < 1e7) THEN CAST({v} AS VARCHAR)
        ELSE {sign} || {used}[1] || '.' || coalesce(nullif({used}[2:], ''), '0') || 'E' || {exponent} END"""


def _hash(columns, doubles) -> str:
    texts = (f"coalesce({_double_text(c) if c in doubles else c}, '<NULL>')" for c in columns)
    return f"sha256(concat_ws('||', {', '.join(texts)}))"


_BRONZE_HASH = _hash(OBSERVATION_MATERIAL, {"value"})
_MART_HASH = _hash(MART_PAYLOAD, {"current_value", "previous_value", "change_value", "change_pct"})
_LATEST = """row_number() OVER (PARTITION BY observation_id ORDER BY ingested_at DESC NULLS LAST, {h} DESC) = 1"""


def _classified(source: str) -> str:
    return f"""SELECT *, CASE WHEN observation_id IS NULL OR observation_id = '' THEN 'missing_observation_id'
        WHEN company_id IS NULL OR company_id = '' THEN 'missing_company_id'
        WHEN metric_id IS NULL OR metric_id = '' THEN 'missing_metric_id'
        WHEN period_id IS NULL OR period_id = '' THEN 'missing_period_id'
        WHEN NOT regexp_full_match(period_id, '[0-9]{{4}}Q[1-4]\\n?') THEN 'invalid_period_id'
        WHEN value IS NULL OR isnan(value) OR isinf(value) THEN 'invalid_value'
        WHEN ingested_at IS NULL THEN 'invalid_ingested_at' END AS rejection_reason
      FROM (SELECT trim(observation_id, ' ') AS observation_id, trim(company_id, ' ') AS company_id, trim(metric_id, ' ') AS metric_id,
        trim(period_id, ' ') AS period_id, value, ingested_at FROM {source})"""


_CLASSIFIED = _classified("slice4_bronze")


def _valid(source: str) -> str:
    return f"SELECT * EXCLUDE (rejection_reason) FROM ({_classified(source)}) WHERE rejection_reason IS NULL"


_SILVER = f"""SELECT * FROM (SELECT *, {_BRONZE_HASH} AS silver_record_hash FROM ({_valid("slice4_bronze")}))
    QUALIFY {_LATEST.format(h="silver_record_hash")}"""
_OLD = "SELECT observation_id, company_id, metric_id, period_id, value, ingested_at, silver_record_hash FROM slice4_silver"


def _mart(source: str, hashed: bool = True) -> str:
    compared = f"""SELECT company_id, metric_id, period_id AS current_period_id, value AS current_value,
          lead(period_id) OVER w AS previous_period_id, lead(value) OVER w AS previous_value
        FROM (SELECT * FROM ({source}) WHERE company_id IS NOT NULL AND metric_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY company_id, metric_id, period_id
            ORDER BY ingested_at DESC NULLS LAST, observation_id DESC) = 1)
        WINDOW w AS (PARTITION BY company_id, metric_id ORDER BY period_id DESC)
        QUALIFY row_number() OVER w = 1"""
    changed = f"""SELECT *, current_value - previous_value AS change_value,
          CASE WHEN previous_value <> 0 THEN (current_value - previous_value) / abs(previous_value)
            WHEN previous_value = 0 AND current_value = 0 THEN 0.0 END AS change_pct,
          CASE WHEN previous_value IS NULL THEN NULL WHEN current_value - previous_value > 0 THEN 'up'
            WHEN current_value - previous_value < 0 THEN 'down' ELSE 'neutral' END AS direction
        FROM ({compared})"""
    return f"SELECT *, {_MART_HASH} AS gold_record_hash FROM ({changed})" if hashed else changed


def _differs(columns) -> str:
    return " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in columns)


def _action(key: str, columns, delete: bool) -> str:
    gone = "D" if delete else "N"
    return f"""CASE WHEN t.{key} IS NULL THEN 'I' WHEN s.{key} IS NULL THEN '{gone}'
        WHEN {_differs(columns)} THEN 'U' ELSE 'N' END"""


def _silver_actions(delete: bool) -> str:
    return f"""SELECT coalesce(t.observation_id, s.observation_id) AS observation_id,
        {_action("observation_id", OBSERVATION_MATERIAL, delete)} AS action
      FROM ({_OLD}) t FULL JOIN ({_SILVER}) s ON t.observation_id = s.observation_id"""


_SILVER_COLUMNS = ("observation_id", *OBSERVATION_MATERIAL, "ingested_at", "silver_record_hash")
_SYNC = f"""SELECT {", ".join(f"CASE WHEN a IN ('I', 'U') THEN s_{c} ELSE t_{c} END AS {c}" for c in _SILVER_COLUMNS)} FROM (
    SELECT {_action("observation_id", OBSERVATION_MATERIAL, True)} AS a,
      {", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in _SILVER_COLUMNS)}
    FROM ({_OLD}) t FULL JOIN ({_SILVER}) s ON t.observation_id = s.observation_id) WHERE a <> 'D'"""


def _joined(old: str, new: str, keys, material, columns, delete: bool) -> str:
    """Every row of either side with its action; columns of the new side where it is taken."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"""SELECT {", ".join(f"CASE WHEN a IN ('I', 'U') THEN s_{c} ELSE t_{c} END AS {c}" for c in columns)}, a FROM (
        SELECT CASE WHEN NOT coalesce(t.there, false) THEN 'I' WHEN NOT coalesce(s.there, false) THEN '{"D" if delete else "N"}'
            WHEN {_differs(material)} THEN 'U' ELSE 'N' END AS a, {", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in columns)}
        FROM (SELECT *, true AS there FROM ({old})) t FULL JOIN (SELECT *, true AS there FROM ({new})) s ON {on})"""


_SIX = ("observation_id", *OBSERVATION_MATERIAL, "ingested_at")
_LATEST_BRONZE = f"""SELECT {", ".join(_SIX)} FROM (SELECT *, {_BRONZE_HASH} AS h FROM slice4_bronze) QUALIFY {_LATEST.format(h="h")}"""
# Loads onto tables that exist, each stage once.
_STAGES = f"""WITH b AS MATERIALIZED ({_joined(f"SELECT {', '.join(_SIX)} FROM slice4_silver", _LATEST_BRONZE, ["observation_id"], OBSERVATION_MATERIAL, _SIX, False)}),
    judged AS MATERIALIZED ({_classified("b")}),
    fresh AS (SELECT * FROM (SELECT * EXCLUDE (rejection_reason), {_BRONZE_HASH} AS silver_record_hash FROM judged WHERE rejection_reason IS NULL)
        QUALIFY {_LATEST.format(h="silver_record_hash")}),
    silver AS MATERIALIZED ({_joined(_OLD, "SELECT * FROM fresh", ["observation_id"], OBSERVATION_MATERIAL, (*_SIX, "silver_record_hash"), True)}),
    gold AS MATERIALIZED ({_joined("SELECT * EXCLUDE (computed_at) FROM slice4_gold", _mart("SELECT * EXCLUDE (a) FROM silver WHERE a <> 'D'"),
        ["company_id", "metric_id"], (*MART_PAYLOAD, "gold_record_hash"), ("company_id", "metric_id", *MART_PAYLOAD, "gold_record_hash"), True)})"""
_KEPT = "CAST(count_if(a <> 'D') AS BIGINT)"


def _told(layer: str, source: str, **counters: str) -> str:
    return " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{name}' AS counter, CAST(({x}) AS BIGINT) AS n FROM {source}" for name, x in counters.items())


_CHANGES = {"inserted_rows": "count_if(a = 'I')", "updated_rows": "count_if(a = 'U')"}
_NONE = "count_if(false)"
_NO_CHANGES = {"inserted_rows": _NONE, "updated_rows": _NONE}


def _silver_counters(layer: str, changes: dict[str, str], deleted: str) -> str:
    ids = "count(DISTINCT CASE WHEN rejection_reason IS NULL THEN observation_id END)"
    judged = {"bronze_input_rows": "count(*)", "bronze_structurally_valid_rows": "count_if(rejection_reason IS NULL)",
              "bronze_rejected_rows_total": "count_if(rejection_reason IS NOT NULL)", "silver_batch_rows_after_dedup": ids, "bronze_distinct_valid_observation_ids": ids}
    written = changes | {"silver_deleted_rows": deleted, "silver_final_row_count": "count_if(a <> 'D')", "reconciliation_delta": _NONE}
    return f"""{_told(layer, "judged", **judged)} UNION ALL {_told(layer, "silver", **written)}
        UNION ALL SELECT '{layer}', rejection_reason, count(*) FROM judged WHERE rejection_reason IS NOT NULL GROUP BY 2"""


def _gold_counters(layer: str, changes: dict[str, str], deleted: str) -> str:
    rows = "count_if(a <> 'D')"
    return _told(layer, "silver", silver_input_rows=rows) + " UNION ALL " + _told(
        layer, "gold", silver_distinct_company_metric_keys=rows, gold_batch_rows=rows, **changes, deleted_rows=deleted, gold_final_row_count=rows, reconciliation_delta=_NONE
    )


_COUNTERS = f"""{_STAGES} {_told("bronze", "slice4_bronze", input_rows="count(*)")} UNION ALL {_told("bronze", f"({_LATEST_BRONZE})", batch_rows_after_dedup="count(*)")}
    UNION ALL {_told("bronze", "b", **_CHANGES, final_row_count="count(*)")}
    UNION ALL {_silver_counters("silver", _CHANGES, "count_if(a = 'D')")} UNION ALL {_gold_counters("gold", _CHANGES, "count_if(a = 'D')")}
    UNION ALL {_silver_counters("silver_rerun", _NO_CHANGES, _NONE)} UNION ALL {_gold_counters("gold_rerun", _NO_CHANGES, _NONE)}"""
_HISTORY = f"""{_STAGES} SELECT 1::BIGINT AS version, 'CREATE' AS operation, count(*) AS inserted_rows, 0::BIGINT AS updated_rows, 0::BIGINT AS deleted_rows,
      count(*) AS final_rows, count(*) AS rows_read FROM slice4_gold
    UNION ALL SELECT 2, 'SYNC', CAST(count_if(a = 'I') AS BIGINT), CAST(count_if(a = 'U') AS BIGINT), CAST(count_if(a = 'D') AS BIGINT), {_KEPT}, {_KEPT} FROM gold"""
_INGESTED = """SELECT observation_id, company_id, metric_id, period_id, CASE WHEN company_id IS NOT NULL THEN value END AS value,
    CASE WHEN metric_id IS NOT NULL THEN ingested_at END AS ingested_at FROM slice4_bronze"""
_MART_COLUMNS = ("company_id", "metric_id", *MART_PAYLOAD, "gold_record_hash")
_GOLD_SYNC = f"""SELECT {", ".join(f"CASE WHEN action IN ('I', 'U') THEN s_{c} ELSE t_{c} END AS {c}" for c in _MART_COLUMNS)}, action FROM (
    SELECT {_action("company_id", (*MART_PAYLOAD, "gold_record_hash"), True)} AS action,
      {", ".join(f"t.{c} AS t_{c}, s.{c} AS s_{c}" for c in _MART_COLUMNS)}
    FROM slice4_gold t FULL JOIN ({_mart(_SILVER)}) s ON t.company_id = s.company_id AND t.metric_id = s.metric_id)"""


def _space_trimmed(column: str) -> str:
    return f"trim({column}, '{WHITE_SPACE}')"


_ID = f"nullif({_space_trimmed('observation_id')}, '')"
_P2 = f"""WITH latest AS (SELECT snapshot_id, {_ID} AS id, value, period_id FROM slice4_snapshots
      WHERE {_ID} IS NOT NULL AND snapshot_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY snapshot_id, {_ID} ORDER BY ingested_at DESC NULLS LAST) = 1),
    pairs AS (SELECT snapshot_id AS before, lead(snapshot_id) OVER (ORDER BY snapshot_id) AS after
      FROM (SELECT DISTINCT snapshot_id FROM slice4_snapshots WHERE snapshot_id IS NOT NULL)),
    old AS (SELECT p.after AS snapshot_id, id, value, period_id FROM latest JOIN pairs p ON snapshot_id = p.before WHERE p.after IS NOT NULL),
    new AS (SELECT * FROM latest WHERE snapshot_id IN (SELECT after FROM pairs))
  SELECT coalesce(o.snapshot_id, n.snapshot_id) AS snapshot_id, coalesce(o.id, n.id) AS observation_id,
    CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
  FROM old o FULL JOIN new n ON o.snapshot_id = n.snapshot_id AND o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR o.value IS DISTINCT FROM n.value OR o.period_id IS DISTINCT FROM n.period_id"""

_PARTICIPANTS = f"""SELECT row_id, batch_id, value, ingested_at, {_space_trimmed('period_id')} AS p,
    nullif({_space_trimmed('company_id')}, '') AS c, nullif({_space_trimmed('metric_id')}, '') AS m,
    ingested_at - (make_date(CAST(left({_space_trimmed('period_id')}, 4) AS INTEGER), 3 * CAST(right({_space_trimmed('period_id')}, 1) AS INTEGER) - 2, 1) + INTERVAL 3 MONTH) AS lateness
  FROM slice4_bronze WHERE regexp_full_match({_space_trimmed('period_id')}, '(201[5-9]|202[0-4])Q[1-4]')
    AND ingested_at >= TIMESTAMP '2015-01-01' AND ingested_at < TIMESTAMP '2027-01-01'"""
_P4 = f"""WITH r AS ({_PARTICIPANTS}),
    node AS (SELECT c, m, p, min(ingested_at) AS first FROM r WHERE c IS NOT NULL AND m IS NOT NULL GROUP BY c, m, p),
    later AS (SELECT c, m, p, min(first) OVER (PARTITION BY c, m ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS overtaker FROM node)
  SELECT row_id, CASE WHEN epoch_us(ingested_at) - epoch_us(ingested_at - lateness) > 200 * 86400000000 THEN 'too_late' ELSE 'late' END AS kind
  FROM r WHERE epoch_us(ingested_at) - epoch_us(ingested_at - lateness) > 45 * 86400000000
  UNION ALL SELECT row_id, 'overtaken' FROM r JOIN later USING (c, m, p) WHERE overtaker < ingested_at"""
# A double times a power of two is a whole number, so these sums are exact (for values from 2e-7 to 9e15).
_P4_PERIODS = f"""WITH r AS ({_PARTICIPANTS}),
    taken AS (SELECT CAST(regexp_extract(batch_id, '-([0-9]+)$', 1) AS INTEGER) AS load_number, p,
        CAST(value * pow(2, 74) AS HUGEINT) AS v, epoch_us(ingested_at) - epoch_us(ingested_at - lateness) > 45 * 86400000000 AS late
      FROM r WHERE epoch_us(ingested_at) - epoch_us(ingested_at - lateness) <= 200 * 86400000000
        AND value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)),
    loads AS (SELECT DISTINCT load_number FROM taken),
    state AS (SELECT l.load_number, p, count(*) AS n, sum(v) AS total, CAST(count_if(late) AS BIGINT) AS late
      FROM loads l JOIN taken t ON t.load_number <= l.load_number GROUP BY ALL)
  SELECT load_number, p AS period_id, n AS value_count, CAST(total AS DOUBLE) / pow(2, 74) AS value_sum, late AS late_count,
    CAST(coalesce(sum(n) OVER (PARTITION BY load_number ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS later_count
  FROM state"""
_P5 = f"""SELECT row_id FROM (SELECT row_id, ingested_at, {_ID} AS id FROM slice4_bronze) WHERE id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST, row_id) > 1"""

_LINES = """(SELECT l_orderkey || '-' || l_linenumber AS observation_id, 'S' || l_suppkey AS company_id, l_returnflag AS metric_id,
    year(l_shipdate) || 'Q' || quarter(l_shipdate) AS period_id, l_extendedprice AS value, l_shipdate AS ingested_at FROM lineitem)"""
_EVENTS = """(SELECT CAST(event_id AS VARCHAR) AS observation_id, CAST(user_id AS VARCHAR) AS company_id, event_type AS metric_id,
    year(ts) || 'Q' || quarter(ts) AS period_id, value, ts AS ingested_at FROM events)"""



def _profile(column: str, number: str, nan: str, violates: str) -> str:
    return f"""SELECT batch_id, '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS row_count,
        CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_count, CAST(coalesce(sum(n) FILTER ({nan}), 0) AS BIGINT) AS nan_count,
        count(k) AS distinct_count, CAST(coalesce(sum(n) FILTER ({violates}), 0) AS BIGINT) AS violation_count,
        CAST(min({number}) AS DOUBLE) AS low, CAST(max({number}) AS DOUBLE) AS high,
        round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy
      FROM (SELECT batch_id, {column} AS k, count(*) AS n FROM slice4_bronze GROUP BY ALL) GROUP BY batch_id"""


_P1_PROFILE = " UNION ALL ".join(
    (
        _profile("period_id", "CAST(NULL AS DOUBLE)", "false", f"k IS NOT NULL AND NOT regexp_full_match({_space_trimmed('k')}, '[0-9]{{4}}Q[1-4]')"),
        _profile("value", "CASE WHEN NOT isnan(k) AND NOT isinf(k) THEN k END", "isnan(k)", "isinf(k)"),
        _profile("ingested_at", "epoch_us(k)", "false", "k < TIMESTAMP '2015-01-01' OR k > TIMESTAMP '2026-12-31 23:59:59.999999'"),
    )
)



def _shown(value: str, decimals: int, plus: str = "") -> str:
    t = f"format('{{:.{decimals}f}}', {value})"
    return f"""CASE WHEN {t} LIKE '-%' THEN '-' ELSE '{plus}' END || format('{{:,}}', CAST(split_part(ltrim({t}, '-'), '.', 1) AS BIGINT))
        || '.' || split_part({t}, '.', 2)"""


_SHOWN = {c: _shown(c, 2) for c in ("current_value", "previous_value", "change_value")} | {"change_pct": _shown("(change_pct * 100)", 1, "+") + " || '%'"}

ORACLES = {
    "bronze_latest": f"""SELECT * FROM (SELECT observation_id, company_id, metric_id, period_id, value, ingested_at, {_BRONZE_HASH} AS record_hash FROM slice4_bronze)
        QUALIFY {_LATEST.format(h="record_hash")}""",
    "silver_classified": _CLASSIFIED,
    "silver_rejected_by_reason": f"SELECT rejection_reason, count(*) AS rejected_rows FROM ({_CLASSIFIED}) WHERE rejection_reason IS NOT NULL GROUP BY 1",
    "silver_snapshot": _SILVER,
    "silver_counters": f"""SELECT count(*) AS bronze_input_rows, CAST(count_if(rejection_reason IS NULL) AS BIGINT) AS bronze_structurally_valid_rows,
        CAST(count_if(rejection_reason IS NOT NULL) AS BIGINT) AS bronze_rejected_rows_total,
        count(DISTINCT CASE WHEN rejection_reason IS NULL THEN observation_id END) AS bronze_distinct_valid_observation_ids FROM ({_CLASSIFIED})""",
    "upsert_actions": _silver_actions(False),
    "sync_actions": _silver_actions(True),
    "sync_result": _SYNC,
    "sync_metrics": f"""SELECT CAST(count_if(action = 'I') AS BIGINT) AS inserted_rows, CAST(count_if(action = 'U') AS BIGINT) AS updated_rows,
        CAST(count_if(action = 'D') AS BIGINT) AS deleted_rows FROM ({_silver_actions(True)})""",
    "silver_inserted": f"SELECT observation_id FROM ({_SILVER}) WHERE observation_id NOT IN (SELECT observation_id FROM slice4_silver)",
    "silver_orphans": f"SELECT observation_id FROM slice4_silver WHERE observation_id NOT IN (SELECT observation_id FROM ({_SILVER}))",
    "gold_same_period": f"""SELECT * EXCLUDE (silver_record_hash) FROM ({_OLD}) QUALIFY row_number() OVER
        (PARTITION BY company_id, metric_id, period_id ORDER BY ingested_at DESC NULLS LAST, observation_id DESC) = 1""",
    "gold_snapshot": _mart(_OLD),
    "gold_sync_actions": _GOLD_SYNC,
    "serving_companies": "SELECT DISTINCT company_id FROM slice4_gold WHERE company_id IS NOT NULL ORDER BY company_id",
    "serving_metrics": f"SELECT DISTINCT metric_id FROM slice4_gold WHERE company_id = '{HOT_COMPANY}' AND metric_id IS NOT NULL ORDER BY metric_id",
    "serving_comparison": f"SELECT company_id, metric_id, {', '.join(MART_PAYLOAD)} FROM slice4_gold WHERE company_id = '{HOT_COMPANY}' ORDER BY metric_id",
    "display_rows": f"""SELECT {", ".join(f"coalesce({_SHOWN.get(c, c)}, 'N/A') AS {c}" for c in ("company_id", "metric_id", *MART_PAYLOAD))} FROM slice4_gold""",
    "pipeline_bronze_silver_gold": _mart(_SILVER.replace("FROM slice4_bronze", f"""FROM (SELECT * FROM slice4_bronze
        QUALIFY {_LATEST.format(h=_BRONZE_HASH)})""")),
    "layer_counters": _COUNTERS,
    "commit_history": _HISTORY,
    "merged_mart": f"{_STAGES} SELECT * EXCLUDE (a) FROM gold WHERE a <> 'D'",
    "ingested_text": _INGESTED,
    "lineitem_gold": _mart(_valid(_LINES), hashed=False),
    "events_gold": _mart(_valid(_EVENTS), hashed=False),
    "p1_profile": _P1_PROFILE,
    "p1_maintained": _P1_PROFILE,
    "p2_found": _P2,
    "p3_limits": f"""SELECT row_id FROM slice4_bronze b LEFT JOIN metric_catalog c
        ON split_part({_space_trimmed('b.metric_id')}, '@', 1) = c.metric_code
        WHERE NOT isnan(value) AND (isinf(value) OR value < lower_limit OR value > upper_limit)""",
    "p4_found": _P4,
    "p4_periods": _P4_PERIODS,
    "p4_resumed": _P4_PERIODS,
    "p5_found": _P5,
    "p5_kept": f"""SELECT row_id, {_space_trimmed('observation_id')} AS observation_id, value FROM slice4_bronze
        WHERE row_id NOT IN ({_P5})""",
}
