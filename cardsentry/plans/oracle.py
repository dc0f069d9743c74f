"""DuckDB SQL for the registered queries, written from the rules rather than the plans.

Each statement is put together from common table expressions over the given tables.
Sequence matches look forward from the probes here (the Spark plan looks back from the
large row), trailing counts use sliding frames, and nothing is cut into slices.
"""

from __future__ import annotations

from cardsentry.functions.risk import UNUSUAL_CATEGORIES
from cardsentry.operators.feedback import GRID, TUNED
from cardsentry.operators.rules import SPECS, bound_text, default_rules
from cardsentry.schema import CARD_TESTING, GEO_IMPOSSIBLE, RULE_IDS, VELOCITY
from cardsentry.sources.centroids import CENTROIDS

_RULES = default_rules()
# Parameters of the registered queries: 2024-01-16, 2024-01-11 and 2024-01-21, rules switched off.
HALF_WAY_MS = 1_705_363_200_000
THIRDS_MS = (1_704_931_200_000, 1_705_795_200_000)
DISABLED = (VELOCITY, GEO_IMPOSSIBLE, CARD_TESTING)
ORACLE_SQL: dict[str, str] = {}


def _tx(burst: bool = True, where: str = "true") -> str:
    at = "(ms // 86400000) * 86400000 + (ms % 86400000) // 96" if burst else "ms"
    card = "user_id // 10" if burst else "user_id"
    return f"""
ev AS (SELECT *, epoch_us(ts) // 1000 AS ms, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k
       FROM events),
tx AS (SELECT event_id, 'tx-' || event_id AS transaction_id, 'card-' || ({card}) AS card_id,
  CAST(round(value * 100) AS BIGINT) * (CASE WHEN event_type = 'purchase' THEN 20 ELSE 1 END)
    AS amount_minor,
  'USD' AS currency, 'm-' || (event_id % 50) AS merchant_id,
  CASE WHEN event_id % 97 <> 0 THEN (['5411','5812','5541','7995','5999','5967','5311','6051',
    '4121','5732'])[event_id % 10 + 1] END AS merchant_category,
  CASE k % 10 WHEN 0 THEN (['US','GB','JP','XX','BR'])[event_id % 5 + 1] WHEN 1 THEN 'BE'
    ELSE 'NL' END AS country_code,
  CASE WHEN k % 4 <> 0 THEN 'dev-' || user_id END AS device_fingerprint,
  CAST({at} AS BIGINT) AS event_ms
  FROM ev WHERE {where})"""


_PLACES = "places(code, lat, lon) AS (VALUES " + ", ".join(
    f"('{c}', {lat}::DOUBLE, {lon}::DOUBLE)" for c, (lat, lon) in CENTROIDS.items()) + ")"


def _km(a: str, b: str) -> str:
    half_lat = f"pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)"
    half_lon = f"pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)"
    inner = f"({half_lat} + cos(radians({a}.lat)) * cos(radians({b}.lat)) * {half_lon})"
    return f"12742.0 * atan2(sqrt({inner}), sqrt(1 - {inner}))"


def _facts(burst: bool = True, window_s: int = 60, large: str = "50000",
           where: str = "true") -> str:
    unusual = ", ".join(f"'{c}'" for c in UNUSUAL_CATEGORIES)
    return f"""{_tx(burst, where)}, {_PLACES},
seen AS (SELECT *,
  count(*) OVER (PARTITION BY card_id ORDER BY event_ms
                 RANGE BETWEEN {window_s * 1000 - 1} PRECEDING AND CURRENT ROW)
  - count(*) OVER (PARTITION BY card_id, event_ms)
  + row_number() OVER (PARTITION BY card_id, event_ms ORDER BY transaction_id) AS n_recent,
  count(*) OVER past AS n_prior, sum(amount_minor) OVER past AS total_prior,
  lag(country_code) OVER line AS prev_country, lag(event_ms) OVER line AS prev_ms
  FROM tx
  WINDOW line AS (PARTITION BY card_id ORDER BY event_ms, transaction_id),
         past AS (PARTITION BY card_id ORDER BY event_ms, transaction_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
facts AS (SELECT s.*, CAST(total_prior AS DOUBLE) / nullif(n_prior, 0) AS mean_prior,
  event_ms - prev_ms AS gap_ms,
  CASE WHEN prev_country <> country_code THEN {_km('a', 'b')} END AS km,
  1 / (1 + exp(-(-3.0 + CASE WHEN merchant_category IN ({unusual}) THEN 1.6 ELSE 0 END
    + CASE WHEN device_fingerprint IS NULL THEN 1.4 ELSE 0 END
    + CASE WHEN (event_ms // 3600000) % 24 BETWEEN 1 AND 4 THEN 1.2 ELSE 0 END
    + CASE WHEN amount_minor >= 100000 THEN 1.3 ELSE 0 END)::DOUBLE)) AS risk
  FROM seen s LEFT JOIN places a ON a.code = s.prev_country
              LEFT JOIN places b ON b.code = s.country_code),
geo AS (SELECT *, km / (gap_ms / 3600000.0::DOUBLE) AS kmh FROM facts
  WHERE km IS NOT NULL AND gap_ms > 0 AND gap_ms <= 21600000),
{_testing(large)}"""


def _testing(large: str = "50000") -> str:
    """Complete runs of three probes, each with the first large row after its last probe."""
    return f"""probe AS (SELECT *, lag(event_ms, 2) OVER w AS first_ms,
    sum(amount_minor) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run_total
  FROM tx WHERE amount_minor <= 500
  WINDOW w AS (PARTITION BY card_id ORDER BY event_ms, transaction_id)),
ahead AS (SELECT card_id, event_ms, transaction_id, first_ms, run_total, NULL AS large
  FROM probe WHERE first_ms IS NOT NULL
  UNION ALL
  SELECT card_id, event_ms, transaction_id, NULL, NULL,
    {{'id': transaction_id, 'ms': event_ms, 'amount': amount_minor}}
  FROM tx WHERE amount_minor >= {large}),
matched AS (SELECT *, last_value(large IGNORE NULLS) OVER (PARTITION BY card_id
    ORDER BY event_ms DESC, transaction_id DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l FROM ahead),
testing AS (SELECT l.id AS transaction_id, card_id, l.ms AS event_ms, l.amount AS large_amount,
    run_total, (l.ms - first_ms) // 1000 AS span_seconds
  FROM matched WHERE first_ms IS NOT NULL AND l IS NOT NULL AND l.ms - first_ms < 300000)"""


def _hits(burst: bool = True, window_s: int = 60, max_count: int = 5, where: str = "true") -> str:
    return f"""{_facts(burst, window_s, where=where)},
hits AS (
  SELECT transaction_id, card_id, event_ms, 'velocity' AS rule_id, 30 AS weight FROM facts
  WHERE n_recent > {max_count}
  UNION ALL SELECT transaction_id, card_id, event_ms, 'amount_anomaly', 25 FROM facts
  WHERE n_prior >= 5 AND amount_minor >= 5000 AND amount_minor > mean_prior * 6
  UNION ALL SELECT transaction_id, card_id, event_ms, 'geo_impossible', 40 FROM geo WHERE kmh > 900
  UNION ALL SELECT transaction_id, card_id, event_ms, 'model_score', 35 FROM facts WHERE risk >= 0.75
  UNION ALL SELECT transaction_id, card_id, event_ms, 'card_testing', 45 FROM testing)"""


def _scored(distinct_testing: bool = False, where: str = "true", without: tuple[str, ...] = ()) -> str:
    source = "(SELECT DISTINCT * FROM hits)" if distinct_testing else "hits"
    if without:
        listed = ", ".join(f"'{r}'" for r in without)
        source = f"(SELECT * FROM hits WHERE rule_id NOT IN ({listed}))"
    return f"""{_hits(where=where)},
per_tx AS (SELECT transaction_id, CAST(sum(weight) AS INTEGER) AS score,
    CAST(count(*) AS INTEGER) AS n_hits, string_agg(rule_id, ',' ORDER BY rule_id) AS rule_ids
  FROM {source} GROUP BY 1),
scored AS (SELECT t.*, coalesce(p.score, 0) AS score, coalesce(p.n_hits, 0) AS n_hits,
    coalesce(p.rule_ids, '') AS rule_ids, event_ms + 200 + event_id * 7919 % 5000 AS scored_ms
  FROM tx t LEFT JOIN per_tx p USING (transaction_id))"""


_ALERT = """transaction_id, card_id, score, rule_ids, n_hits, amount_minor, currency, merchant_id,
  merchant_category, country_code, event_ms, scored_ms"""
_TX_COLUMNS = """transaction_id, card_id, amount_minor, currency, merchant_id, merchant_category,
  country_code, device_fingerprint, event_ms"""


def _add(name: str, ctes: str, select: str) -> None:
    ORACLE_SQL[name] = f"WITH {ctes}\n{select}"


# Parse. Kinds of damage go by the last two digits of the event id.
_BAD = "(11, 22, 33, 44, 55, 66, 77)"
_add("parse_valid", _tx(), f"SELECT {_TX_COLUMNS} FROM tx WHERE event_id % 100 NOT IN {_BAD}")
_DAMAGED = _tx() + """,
lines AS (SELECT event_id % 100 AS kind, event_id, transaction_id,
  '{"transactionId":"' || transaction_id || '","cardId":"' || card_id || '","amountMinor":'
  || CASE event_id % 100 WHEN 33 THEN '-1' || amount_minor WHEN 77 THEN amount_minor || '.7'
     ELSE amount_minor::VARCHAR END
  || ',"currency":"USD","merchantId":"' || merchant_id || '"'
  || coalesce(',"merchantCategory":"' || merchant_category || '"', '')
  || ',"countryCode":"' || country_code || '"'
  || coalesce(',"deviceFingerprint":"' || device_fingerprint || '"', '')
  || ',"eventTime":' || event_ms || '}' AS body FROM tx)"""
_LETTER = """'Failed to parse Transaction' AS error,
  CASE kind WHEN 11 THEN '{not json ' || event_id
    WHEN 22 THEN '{"transactionId":"' || transaction_id || '"}'
    WHEN 44 THEN substr(event_id || repeat('x', 5000), 1, 1024) || '...'
    WHEN 55 THEN '' WHEN 66 THEN '[]' ELSE body END AS payload"""
_add("parse_dlq", _DAMAGED, f"""SELECT {_LETTER},
  CASE kind WHEN 22 THEN 'missing cardId' WHEN 33 THEN 'negative amountMinor'
    ELSE 'malformed' END AS reason
FROM lines WHERE kind IN {_BAD}""")
_add("parse_counters", _DAMAGED, f"""SELECT CASE WHEN kind NOT IN {_BAD} THEN 'parsed'
    WHEN kind = 22 THEN 'missing cardId' WHEN kind = 33 THEN 'negative amountMinor'
    ELSE 'malformed' END AS outcome, count(*) AS lines FROM lines GROUP BY 1""")
_add("transaction_wire", _tx() + """,
lines AS (SELECT transaction_id, '{"transactionId":"' || transaction_id || '","cardId":"' || card_id
  || '","amountMinor":' || amount_minor || ',"currency":"USD","merchantId":"' || merchant_id || '"'
  || coalesce(',"merchantCategory":"' || merchant_category || '"', '')
  || ',"countryCode":"' || country_code || '"'
  || coalesce(',"deviceFingerprint":"' || device_fingerprint || '"', '')
  || ',"eventTime":' || event_ms || '}' AS line FROM tx)""", "SELECT transaction_id, line FROM lines")
_add("stream_dlq", _DAMAGED, f"SELECT {_LETTER} FROM lines WHERE kind IN {_BAD}")
_add("dedupe_transactions", _tx(), f"SELECT {_TX_COLUMNS} FROM tx")

# Facts.
_FACT_VIEW = """
SELECT transaction_id, n_recent AS velocity_count, n_prior AS prior_count,
  CAST(coalesce(total_prior, 0) AS BIGINT) AS prior_total, prev_country, gap_ms,
  CAST((SELECT count(*) FROM testing t WHERE t.transaction_id = f.transaction_id) AS INTEGER)
    AS n_runs, round(km, 4) AS travel_km FROM facts f"""
_add("card_facts", _facts(), _FACT_VIEW)
_add("card_facts_split", _facts(), _FACT_VIEW)
_add("card_facts_hourly", _facts(False, 3600), _FACT_VIEW)
# A card that was away for more than a day is another card from then on.
_add("card_facts_ttl", _facts(False).replace("tx AS (", "raw AS (", 1).replace(
    ", places(", """,
visits AS (SELECT *, CAST(coalesce(event_ms - lag(event_ms) OVER w > 86400000, false) AS INTEGER) AS back
  FROM raw WINDOW w AS (PARTITION BY card_id ORDER BY event_ms, transaction_id)),
tx AS (SELECT * REPLACE (card_id || '/' || sum(back) OVER (PARTITION BY card_id
    ORDER BY event_ms, transaction_id) AS card_id) FROM visits),
places(""", 1), _FACT_VIEW)
_add("risk_probability", _facts(False), "SELECT transaction_id, round(risk, 6) AS risk FROM facts")

# Rules.
_VELOCITY = """SELECT transaction_id, card_id, event_ms, 30 AS weight, 1::BIGINT AS rule_version,
  n_recent AS n, {m} AS max_count, {w} AS window_seconds FROM facts WHERE n_recent > {m}"""
_add("rule_velocity", _facts(), _VELOCITY.format(m=5, w=60))
_add("rule_velocity_hourly", _facts(False, 3600), _VELOCITY.format(m=2, w=3600))
_add("rule_amount_anomaly", _facts(), """
SELECT transaction_id, card_id, event_ms, 25 AS weight, 1::BIGINT AS rule_version, amount_minor,
  CAST(round(mean_prior) AS BIGINT) AS mean_minor, 6.0::DOUBLE AS multiplier,
  n_prior AS observations
FROM facts WHERE n_prior >= 5 AND amount_minor >= 5000 AND amount_minor > mean_prior * 6""")
_GEO = """
SELECT transaction_id, card_id, event_ms, 40 AS weight, 1::BIGINT AS rule_version,
  prev_country AS from_country, country_code AS to_country, CAST(round(km) AS BIGINT) AS km,
  gap_ms // 1000 AS gap_seconds, CAST(round(kmh) AS BIGINT) AS kmh FROM geo WHERE kmh > 900"""
_add("rule_geo_impossible", _facts(), _GEO)
_add("rule_geo_impossible_natural", _facts(False), _GEO)
_add("rule_card_testing", _facts(), """
SELECT transaction_id, card_id, event_ms, 45 AS weight, 1::BIGINT AS rule_version, 3 AS probe_count,
  CAST(run_total AS BIGINT) AS probe_total, large_amount, span_seconds FROM testing""")
_add("rule_model_score", _facts(False), """
SELECT transaction_id, card_id, event_ms, 35 AS weight, 1::BIGINT AS rule_version,
  round(risk, 6) AS probability FROM facts WHERE risk >= 0.75""")
_add("haversine_pairs", f"{_tx()}, {_PLACES}", f"""
SELECT country_code, b.code AS to_country, n, round({_km('a', 'b')}, 4) AS km
FROM (SELECT country_code, count(*) AS n FROM tx GROUP BY 1) s
JOIN places a ON a.code = s.country_code CROSS JOIN places b""")

# Scores and alerts.
_VERDICT = "SELECT transaction_id, card_id, score, n_hits, rule_ids FROM scored"
_add("score_merged", _scored(), _VERDICT)
_add("score_merged_split", _scored(), _VERDICT)
_add("score_deduped_hits", _scored(distinct_testing=True), _VERDICT)
_PARSED = f"event_id % 100 NOT IN {_BAD}"
_add("stream_scored", _scored(where=_PARSED), _VERDICT)
_add("stream_replayed", _scored(where=_PARSED), _VERDICT)
_add("score_disabled_rules", _scored(without=DISABLED), _VERDICT)
def _more_hits(base: str, ctes: str, select: str) -> str:
    """The scored rows of ``base`` with the hits of ``select`` among the others."""
    return base.replace("per_tx AS (", f"{ctes}, every_hit AS (SELECT * FROM hits UNION ALL {select}),\nper_tx AS (", 1
                        ).replace("FROM hits GROUP BY 1", "FROM every_hit GROUP BY 1", 1)


_add("score_own_rule", _more_hits(_scored(), """small AS (SELECT *,
  count(*) FILTER (amount_minor <= 2000) OVER (PARTITION BY card_id ORDER BY event_ms
    RANGE BETWEEN 179999 PRECEDING AND CURRENT ROW)
  - count(*) FILTER (amount_minor <= 2000) OVER (PARTITION BY card_id, event_ms)
  + count(*) FILTER (amount_minor <= 2000) OVER (PARTITION BY card_id, event_ms
    ORDER BY transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_small FROM tx)""",
    "SELECT transaction_id, card_id, event_ms, 'small_amounts', 41 FROM small WHERE n_small > 1"), _VERDICT)
_add("score_own_model", _scored().replace(_tx(), _tx(False)).replace("risk >= 0.75", """
  1 / (1 + exp(2.5 - 1.5 * CAST((event_ms // 3600000) % 24 BETWEEN 1 AND 4 AS INTEGER)
  - 0.75 * CAST(device_fingerprint IS NULL AS INTEGER)
  - 0.25 * ln(1 + amount_minor)::DOUBLE)) >= 0.75"""), _VERDICT)
_add("stream_rule_change", _facts(where=_PARSED), f"""
SELECT transaction_id, CASE WHEN event_ms < {HALF_WAY_MS} THEN 1 ELSE 2 END::BIGINT AS rule_version,
  n_recent AS n FROM facts WHERE n_recent > CASE WHEN event_ms < {HALF_WAY_MS} THEN 5 ELSE 2 END""")
_add("stream_late_rows", _tx(where=_PARSED) + f""",
arrived AS (SELECT *, least(2, CASE WHEN event_ms < {THIRDS_MS[0]} THEN 0
    WHEN event_ms < {THIRDS_MS[1]} THEN 1 ELSE 2 END + CAST(event_id % 40 = 7 AS INTEGER)) AS part FROM tx),
newest AS (SELECT part, max(max(event_ms)) OVER (ORDER BY part
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS mark FROM arrived GROUP BY part)""", """
SELECT transaction_id, part::BIGINT AS batch_id, coalesce(event_ms < mark, false) AS is_late
FROM arrived JOIN newest USING (part)""")
_counted = " UNION ALL ".join(
    f"SELECT 'hits_{r}' AS counter, count(*) AS n FROM hits WHERE rule_id = '{r}'" for r in RULE_IDS)
_add("stream_counters", _scored(where=_PARSED) + f""",
every AS (SELECT event_id, event_id % 100 NOT IN {_BAD} AS fine,
    (epoch_us(ts) // 1000 // 86400000) * 86400000 < {HALF_WAY_MS} AND event_id % 2 = 0 AS again
  FROM events)""", f"""
SELECT 'parsed' AS counter, count(*) + count(*) FILTER (again) AS n FROM every WHERE fine
UNION ALL SELECT 'rejected', count(*) + count(*) FILTER (again) FROM every WHERE NOT fine
UNION ALL SELECT 'replayed', count(*) FROM every WHERE fine AND again
UNION ALL SELECT 'scored', count(*) FROM scored
UNION ALL SELECT 'late', 0 UNION ALL SELECT 'alerts', count(*) FROM scored WHERE score >= 40
UNION ALL {_counted}""")
_add("stream_alerts", _scored(where=_PARSED), f"{_VERDICT} WHERE score >= 40")
_add("alerts_rescored", _scored() + f""",
again AS (SELECT s.* REPLACE (score + 11 * (SELECT count(*) FROM hits h
      WHERE h.transaction_id = s.transaction_id AND rule_id = 'velocity') AS score) FROM scored s
  WHERE event_ms >= {HALF_WAY_MS})""", f"""
SELECT transaction_id, score, rule_ids, scored_ms, scored_ms AS inserted_ms FROM scored
WHERE score >= 40 AND event_ms < {HALF_WAY_MS}
UNION ALL
SELECT a.transaction_id, CAST(a.score AS INTEGER), a.rule_ids, a.scored_ms + 3600000,
  CASE WHEN s.score >= 40 THEN s.scored_ms ELSE s.scored_ms + 3600000 END
FROM again a JOIN scored s USING (transaction_id) WHERE a.score >= 40""")
_OUTSIDE = """base AS (SELECT CASE WHEN event_id % 10 = 9 THEN 'gone-' ELSE 'tx-' END
    || (event_id // 6 * 6) AS transaction_id,
  CASE WHEN event_type = 'click' THEN 'outside_a' ELSE 'outside_b' END AS rule_id,
  event_id % 4 * 5 AS weight, event_id % 2 + 1::BIGINT AS rule_version FROM events WHERE event_id % 3 = 0),
outside AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE weight = 15)"""
_add("score_with_outside_hits", f"{_scored()}, {_OUTSIDE}", """
SELECT transaction_id, CAST(s.score + coalesce(o.w, 0) AS INTEGER) AS score,
  coalesce(o.n, 0) AS n_extra, coalesce(o.extra, '') AS extra
FROM scored s LEFT JOIN (
  SELECT transaction_id, sum(weight) AS w, count(*) AS n,
    (SELECT string_agg(d.rule_id || ':' || d.rule_version, ',' ORDER BY d.rule_id, d.rule_version, d.weight)
     FROM (SELECT DISTINCT * FROM outside) d WHERE d.transaction_id = outside.transaction_id) AS extra
  FROM outside GROUP BY 1) o USING (transaction_id)""")
_add("orphan_hits", f"{_tx()}, {_OUTSIDE}", """
SELECT rule_id, count(*) AS orphans FROM outside
WHERE transaction_id NOT IN (SELECT transaction_id FROM tx) GROUP BY 1""")
_add("alerts_flat", _scored(), f"SELECT {_ALERT} FROM scored WHERE score >= 40")
_add("alerts_by_card", _scored(),
     f"SELECT {_ALERT} FROM scored WHERE score >= 40 AND card_id = 'card-1'")
_add("alerts_by_time", _scored(), f"""SELECT {_ALERT} FROM scored WHERE score >= 40
AND event_ms >= epoch_ms(TIMESTAMP '2024-01-05 00:00:00')
AND event_ms < epoch_ms(TIMESTAMP '2024-01-12 00:00:00')""")
_add("alerts_by_rule", _scored(), f"""SELECT {_ALERT} FROM scored
WHERE score >= 40 AND list_contains(string_split(rule_ids, ','), 'amount_anomaly')""")
_add("alerts_page", _scored(), f"""SELECT {_ALERT} FROM scored WHERE score >= 40
AND (event_ms < epoch_ms(TIMESTAMP '2024-01-20 00:05:00')
  OR (event_ms = epoch_ms(TIMESTAMP '2024-01-20 00:05:00') AND transaction_id > ''))
ORDER BY event_ms DESC, transaction_id LIMIT 50""")
_add("alerts_upsert", _scored(), """
SELECT transaction_id, score + CASE WHEN amount_minor % 2 = 0 THEN 1 ELSE 0 END AS score, n_hits,
  scored_ms + CASE WHEN amount_minor % 2 = 0 THEN 3600000 ELSE 0 END AS scored_ms,
  scored_ms AS inserted_ms FROM scored WHERE score >= 40""")
_add("hits_per_rule", _hits(), """
SELECT rule_id, count(*) AS hits, CAST(sum(weight) AS BIGINT) AS points FROM hits GROUP BY 1""")


# Rule table.
def _history() -> str:
    def map_of(pairs: list[tuple[str, str]]) -> str:
        return "MAP {" + ", ".join(f"'{k}': ({v})::DOUBLE" for k, v in pairs) + "}"

    cases = []
    for i, rule_id in enumerate(RULE_IDS):
        (name, value), *rest = _RULES[rule_id].params.items()
        first = (f"CASE WHEN event_id % 11 = 3 THEN {value * 1000000} WHEN event_id % 11 = 5 THEN "
                 f"{value + 0.5} WHEN event_id % 19 = 6 THEN 'NaN'::DOUBLE ELSE {value} END")
        others = [(n, f"CASE WHEN event_id % 17 = 2 THEN 50000.0 ELSE {v} END"
                   if n == "probeMaxAmountMinor" else str(v)) for n, v in rest]
        cases.append(f"WHEN event_id % 6 = {i} AND event_id % 13 = 4 THEN "
                     + map_of([("bogus", "1.0"), *others]))
        cases.append(f"WHEN event_id % 6 = {i} THEN " + map_of([(name, first), *others]))
    names = ", ".join(f"'{r}'" for r in (*RULE_IDS, "nonsense"))
    return f"""history AS (SELECT event_id, ([{names}])[event_id % 6 + 1] AS rule_id,
  event_id // (CASE WHEN event_id % 7 = 0 THEN 120 ELSE 60 END) AS version,
  event_id % 5 <> 0 AS enabled, CAST(event_id % 110 AS INTEGER) AS weight,
  CASE {' '.join(cases)} ELSE MAP {{}}::MAP(VARCHAR, DOUBLE) END AS params,
  'user-' || user_id AS updated_by, epoch_us(ts) // 1000 AS updated_ms FROM events),
checked AS (SELECT *, list_filter({_problem_list()}, lambda x: x IS NOT NULL) AS problems FROM history)"""


def _problem_list() -> str:
    checks = ["CASE WHEN rule_id = 'nonsense' THEN 'unknown ruleId (known: ["
              + ", ".join(sorted(SPECS)) + "])' END",
              "CASE WHEN rule_id <> 'nonsense' AND version < 1 THEN 'version must be >= 1' END",
              "CASE WHEN rule_id <> 'nonsense' AND weight NOT BETWEEN 0 AND 100 "
              "THEN 'weight must be 0..100' END"]
    for rule_id, params in SPECS.items():
        for p in params:
            v = f"params['{p.name}']"
            whole = f"WHEN {v} <> trunc({v}) THEN '{p.name} must be a whole number'" if p.whole else ""
            checks.append(
                f"CASE WHEN rule_id <> '{rule_id}' THEN NULL WHEN {v} IS NULL "
                f"THEN 'missing param {p.name}' WHEN isnan({v}) THEN '{p.name} must be finite' "
                f"WHEN {v} NOT BETWEEN {p.low} AND {p.high} THEN '{p.name} must be "
                f"{bound_text(p.low)}..{bound_text(p.high)}' {whole} END")
    for rule_id, params in SPECS.items():
        allowed = ", ".join(sorted(p.name for p in params))
        checks.append(f"CASE WHEN rule_id = '{rule_id}' AND params['bogus'] IS NOT NULL "
                      f"THEN 'unknown param bogus (allowed: [{allowed}])' END")
    probe, large = "params['probeMaxAmountMinor']", "params['largeAmountMinor']"
    checks.append(f"CASE WHEN rule_id = '{CARD_TESTING}' AND {probe} >= {large} THEN "
                  f"'probeMaxAmountMinor (50000.0) must be < largeAmountMinor (50000.0) "
                  f"for a run to end in a large amount' END")
    return "[" + ", ".join(checks) + "]"


_VALID = "valid AS (SELECT * FROM checked WHERE len(problems) = 0)"
_add("rule_config_problems", _history(), """
SELECT event_id, rule_id, CAST(len(problems) AS INTEGER) AS n_problems,
  array_to_string(problems, '; ') AS problems FROM checked""")
_add("rule_latest_valid", f"{_history()}, {_VALID}", """
SELECT rule_id, version, enabled, weight, updated_by, updated_ms FROM valid
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY version DESC, updated_ms) = 1""")
_LINE = """pushed AS (SELECT rule_id, version, min(updated_ms) AS updated_ms FROM valid GROUP BY 1, 2),
line AS (SELECT p.*, max(version) OVER w AS top,
    CAST(lead(updated_ms) OVER w AS BIGINT) AS until_ms FROM pushed p
  WINDOW w AS (PARTITION BY rule_id ORDER BY updated_ms, version)),
spans AS (SELECT rule_id, top, min(updated_ms) AS from_ms, max(coalesce(until_ms, 1e15)) AS until_ms
  FROM line GROUP BY 1, 2),
stamped AS (SELECT h.*, s.top AS version_in_force,
    (SELECT min(p.updated_ms) FROM pushed p WHERE p.rule_id = s.rule_id AND p.version = s.top)
      AS in_force_since
  FROM hits h LEFT JOIN spans s ON s.rule_id = h.rule_id
    AND h.event_ms >= s.from_ms AND h.event_ms < s.until_ms)"""
_EVER = -(1 << 60)  # a push without a time has been in force all along
_ODD = f"""valid AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 5 THEN {_EVER}
    WHEN event_id % 89 = 3 THEN 253402300799999 ELSE updated_ms END AS updated_ms)
  FROM checked WHERE len(problems) = 0)"""
_add("rule_asof", f"{_hits()}, {_history()}, {_ODD}, {_LINE}", f"""
SELECT transaction_id, rule_id, event_ms, weight, version_in_force,
  nullif(in_force_since, {_EVER}) AS in_force_since FROM stamped""")
_add("hit_rule_version", f"{_hits()}, {_history()}, {_VALID}, {_LINE}", """
SELECT s.transaction_id, s.rule_id, s.version_in_force AS rule_version, v.enabled, v.updated_by,
  map_values(v.params)[1] AS first_param
FROM stamped s LEFT JOIN valid v ON v.rule_id = s.rule_id AND v.version = s.version_in_force
  AND v.updated_ms = s.in_force_since""")

# Batch layer.
_add("daily_card_agg", _scored(), """
SELECT CAST(epoch_ms(event_ms) AS DATE) AS agg_date, card_id, count(*) AS txn_count,
  count(*) FILTER (score >= 40) AS alert_count,
  CAST(sum(amount_minor) AS DECIMAL(38,0)) AS total_amount_minor,
  CAST(count(DISTINCT merchant_id) AS INTEGER) AS distinct_merchants,
  CAST(count(DISTINCT country_code) AS INTEGER) AS distinct_countries,
  max(score) FILTER (score >= 40) AS max_score FROM scored GROUP BY 1, 2""")
_LABELS = """labelled AS (SELECT 'tx-' || event_id AS transaction_id,
  CASE event_id % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'fraud' ELSE 'legit' END AS label FROM events)"""
_RULE_LIST = ", ".join(f"('{r}')" for r in RULE_IDS)
_add("label_fpr", f"{_hits()}, {_LABELS}, r(rule_id) AS (VALUES {_RULE_LIST})", """
SELECT r.rule_id, count(h.transaction_id) AS fired,
  count(h.transaction_id) FILTER (h.label = 'legit') AS fired_legit,
  (SELECT count(*) FROM labelled WHERE label = 'legit') AS legit_rows,
  round(count(h.transaction_id) FILTER (h.label = 'legit')
    / (SELECT count(*) FROM labelled WHERE label = 'legit'), 6) AS fpr
FROM r LEFT JOIN (SELECT DISTINCT hits.rule_id, transaction_id, label FROM hits
  JOIN labelled USING (transaction_id) WHERE label <> 'unknown') h USING (rule_id)
GROUP BY 1""")


def _rates() -> str:
    conditions = {
        VELOCITY: "SELECT transaction_id FROM facts WHERE n_recent > {v}",
        "amount_anomaly": "SELECT transaction_id FROM facts WHERE n_prior >= 5 AND "
                          "amount_minor >= 5000 AND amount_minor > mean_prior * {v}",
        "geo_impossible": "SELECT transaction_id FROM geo WHERE kmh > {v}",
        "model_score": "SELECT transaction_id FROM facts WHERE risk >= {v}",
        CARD_TESTING: "SELECT transaction_id FROM testing_{v}",
    }
    extra, parts = [], []
    for rule_id, values in GRID.items():
        for v in values:
            if rule_id == CARD_TESTING:
                text = _testing(str(v))
                for name in ("probe", "ahead", "matched", "testing"):
                    text = text.replace(f"{name} AS (", f"{name}_{v} AS (")
                    text = text.replace(f"FROM {name} ", f"FROM {name}_{v} ")
                    text = text.replace(f"FROM {name})", f"FROM {name}_{v})")
                extra.append(text)
            parts.append(
                f"SELECT '{rule_id}' AS rule_id, {v}::DOUBLE AS candidate, (SELECT count(DISTINCT "
                f"transaction_id) FROM ({conditions[rule_id].format(v=v)}) JOIN legit "
                f"USING (transaction_id)) AS fired_legit")
    return f"""{_facts()}, {_LABELS}, {', '.join(extra)},
legit AS (SELECT transaction_id FROM labelled WHERE label = 'legit'),
counted AS ({' UNION ALL '.join(parts)}),
rates AS (SELECT *, (SELECT count(*) FROM legit) AS legit_rows,
  fired_legit / (SELECT count(*) FROM legit) AS fpr FROM counted)"""


_add("candidate_fpr", _rates(), """
SELECT rule_id, candidate, fired_legit, legit_rows, round(fpr, 6) AS fpr FROM rates""")
_CURRENT = ", ".join(f"('{r}', {_RULES[r].weight})" for r in TUNED)
_add("rule_retune", f"{_rates()}, current(rule_id, weight) AS (VALUES {_CURRENT})", """
SELECT rule_id, 2::BIGINT AS version, true AS enabled, weight, candidate AS chosen, round(fpr, 6) AS fpr,
  'rule_retune' AS updated_by, 'airflow' AS source
FROM rates JOIN current USING (rule_id)
QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY fpr <= 0.02 DESC,
  CASE WHEN fpr <= 0.02 THEN candidate ELSE -candidate END) = 1""")
_add("latency_percentiles", "d AS (SELECT 200 + event_id * 7919 % 5000 AS delay FROM events)", """
SELECT count(*) AS rows, quantile_disc(delay, 0.5) AS p50, quantile_disc(delay, 0.9) AS p90,
  quantile_disc(delay, 0.99) AS p99 FROM d""")
_add("quality_checks", f"{_scored()}, {_LABELS}", """
SELECT "check", CAST(violations AS BIGINT) AS violations FROM (SELECT 'scored.transaction_id unique' AS "check",
  (SELECT count(*) FROM tx WHERE event_id % 25 = 1) AS violations
UNION ALL SELECT 'scored.amount_minor >= 0', 0
UNION ALL SELECT 'scored.score >= 0', 0
UNION ALL SELECT 'scored.currency has 3 letters', (SELECT count(*) FROM tx WHERE event_id % 50 = 7)
  + (SELECT count(*) FROM tx WHERE event_id % 50 = 7 AND event_id % 25 = 1)
UNION ALL SELECT 'scored.country_code has 2 letters',
  (SELECT sum(CASE WHEN event_id % 25 = 1 THEN 2 ELSE 1 END) FROM tx WHERE event_id % 40 = 9)
UNION ALL SELECT 'scored.rule ids known', 0
UNION ALL SELECT 'scored.score is the sum of weights',
  (SELECT sum(CASE WHEN event_id % 25 = 1 THEN 2 ELSE 1 END) FROM tx WHERE event_id % 30 = 4)
UNION ALL SELECT 'labels.transaction_id unique', 0
UNION ALL SELECT 'labels.label allowed',
  (SELECT count(*) FROM labelled WHERE transaction_id LIKE '%77')
UNION ALL SELECT 'daily_card_agg key unique', 0
UNION ALL SELECT 'daily_card_agg.alert_count <= txn_count', 0
UNION ALL SELECT 'daily_card_agg.max_score only with alerts', 0)""")
