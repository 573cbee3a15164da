"""DuckDB SQL with the same results as the catalogue's queries, written as SQL of its own."""

from __future__ import annotations

import csv

from .. import config
from ..functions.prompt import WAKES
from .catalogue import RUN_SHARD, SEED
from .scenario import LETTERS

_LINES = r"""
l AS (SELECT conv_id, turn, unnest(regexp_split_to_array(upper(role) || ': ' || text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e]')) AS line, generate_subscripts(regexp_split_to_array(upper(role) || ': ' || text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e]'), 1) AS k FROM conversations),
m AS (SELECT conv_id, turn, k, trim(regexp_extract(line, '^\s*([A-Z0-9][A-Z0-9 _\-/]{0,31}?)\s*:\s*(.+?)\s*$', 1)) AS speaker, trim(regexp_extract(line, '^\s*([A-Z0-9][A-Z0-9 _\-/]{0,31}?)\s*:\s*(.+?)\s*$', 2)) AS text
  FROM l WHERE regexp_matches(line, '^\s*([A-Z0-9][A-Z0-9 _\-/]{0,31}?)\s*:\s*(.+?)\s*$'))"""

_JUDGED = f"""{_LINES},
f AS (SELECT DISTINCT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'USER' ELSE 'SYSTEM' END AS focal FROM conversations),
j AS (SELECT f.conv_id, count(m.speaker) AS n_turns, any_value(focal) AS focal, list_sort(list_distinct(list(upper(m.speaker)) FILTER (m.speaker IS NOT NULL))) AS tags FROM f LEFT JOIN m USING (conv_id) GROUP BY f.conv_id),
v AS (SELECT conv_id, n_turns, CASE WHEN n_turns < 4 THEN printf('only %d turns parsed (min 4)', n_turns)
  WHEN NOT coalesce(list_contains(tags, focal), false) THEN 'focal callsign ''' || focal || ''' not found among speakers [''' || array_to_string(tags, ''', ''') || ''']' END AS error FROM j)"""


def _u(slot: str, row: str = "id") -> str:
    return f"(CAST('0x' || substr(sha1('{SEED}:' || CAST({row} AS VARCHAR) || ':' || {slot}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def _pick(u: str, weights: dict) -> str:
    total, run, out = float(sum(weights.values())), 0.0, "CASE"
    for label, weight in weights.items():
        run += weight
        out += f" WHEN {u} * {total!r}::DOUBLE < {run!r}::DOUBLE THEN '{label}'"
    return f"{out} ELSE '{list(weights)[-1]}' END"


def _int(u: str, low, high) -> str:
    return f"({low} + floor({u} * ({high} - ({low}) + 1))::BIGINT)"


def _craft() -> list[list[str]]:
    with (config.RESOURCES / "aircraft.csv").open(newline="") as lines:
        return list(csv.reader(line for line in lines if not line.startswith("#")))[1:]


def _airports() -> str:
    with (config.RESOURCES / "airports.csv").open(newline="") as lines:
        return ", ".join(f"('{a}', '{b}')" for a, b in list(csv.reader(line for line in lines if not line.startswith("#")))[1:])


def _countries() -> str:
    with (config.RESOURCES / "countries.csv").open(newline="") as lines:
        return ", ".join(f"('{a}', '{b}')" for a, b in list(csv.reader(line for line in lines if not line.startswith("#")))[1:])


def _regions() -> str:
    return f"""
air(icao, country) AS (VALUES {_airports()}),
known(country, region) AS (VALUES {_countries()}),
ports AS (SELECT icao, coalesce(region, 'other') AS region FROM air LEFT JOIN known USING (country))"""


def _squawk(u: str) -> str:
    code = f"floor({u} * 4093)::BIGINT"
    for reserved in (3904, 3968, 4032):
        code = f"(SELECT c + CASE WHEN c >= {reserved} THEN 1 ELSE 0 END FROM (SELECT {code} AS c))"
    return f"(SELECT concat(c // 512, c // 64 % 8, c // 8 % 8, c % 8) FROM (SELECT {code} AS c))"


def _scenarios(numbers: str = "SELECT o_orderkey::BIGINT AS id FROM orders") -> str:
    c = config.load()
    tiers = ", ".join(f"('{k}', {c.tier_weights[str(v)]})" for k, v in c.airport_tiers.items())
    members: dict[str, list] = {}
    for code, _, _, wake, classes in _craft():
        for name in classes.split("|"):
            members.setdefault(name, []).append((code, wake))
    operators = {k: v for k, v in c.operator_weights.items() if members.get(k)}
    slot = lambda what: f"'{what}:' || CAST(k AS VARCHAR)"
    code, sign = "CASE kind", "CASE"
    for name, own in members.items():
        own.sort()
        code += f" WHEN '{name}' THEN [{', '.join(repr(f'{t}/{w}') for t, w in own)}][1 + floor({_u(slot('craft'))} * {len(own)})::INT]"
        prefixes = c.operator_prefixes.get(name)
        if prefixes:
            sign += f" WHEN kind = '{name}' THEN [{', '.join(map(repr, prefixes))}][1 + floor({_u(slot('prefix'))} * {len(prefixes)})::INT] || CAST({_int(_u(slot('number')), 1, 9999)} AS VARCHAR)"
    sign += f" ELSE 'N' || substr(lpad(CAST({_int(_u(slot('number')), 0, 99999)} AS VARCHAR), 5, '0'), 1, {_int(_u(slot('width')), 1, 5)}::INT) END"
    w = c.weather
    low = " ".join(f"WHEN '{k}' THEN {r[0]}" for k, r in c.traffic_aircraft_range.items())
    high = " ".join(f"WHEN '{k}' THEN {r[1]}" for k, r in c.traffic_aircraft_range.items())
    wind = " ".join(f"WHEN '{k}' THEN {_int(_u(repr('wind')), *b['range'])}" for k, b in enumerate(w.wind_kt_buckets))
    q = lambda what: _u(f"'{what}'")
    letters = " || ".join(f"substr('{LETTERS}', {_int(q(f'letter:{k}'), 1, len(LETTERS))}::INT, 1)" for k in range(4))
    band = lambda end: " ".join(f"WHEN '{k}' THEN {b[end]}::DOUBLE" for k, b in c.phase_frequency_bands.items())
    between = lambda u, low, high: f"({low}::DOUBLE + {u} * ({high}::DOUBLE - {low}::DOUBLE))"
    return f"""{_regions()},
tiers(icao, weight) AS (VALUES {tiers}),
pool AS (SELECT icao, region, coalesce(weight, {c.tier_weights['default']})::DOUBLE AS weight FROM ports LEFT JOIN tiers USING (icao) WHERE region IN ('us')),
cdf AS (SELECT icao, region, sum(weight) OVER (ORDER BY icao) - weight AS low, sum(weight) OVER (ORDER BY icao) AS high, sum(weight) OVER () AS total FROM pool),
n AS ({numbers}),
d AS (SELECT id, icao, region, {_pick(q('phase'), c.phase_weights)} AS phase, {_pick(q('density'), c.traffic_density_weights)} AS traffic_density,
  {_pick(q('time'), c.time_of_day_weights)} AS time_of_day, {_pick(q('event'), c.event_weights)} AS event, {_pick(q('sky'), w.vmc_imc_weights)} AS vmc_imc
  FROM n JOIN cdf ON {q('icao')} * total >= low AND {q('icao')} * total < high),
many AS (SELECT id, (CASE traffic_density {low} END) + floor({q('many')} * ((CASE traffic_density {high} END) - (CASE traffic_density {low} END) + 1))::BIGINT AS n_aircraft FROM d),
ks AS (SELECT id, unnest(range(n_aircraft)) AS k FROM many),
kinds AS (SELECT id, k, {_pick(_u(slot('class')), operators)} AS kind FROM ks),
craft AS (SELECT id, k, kind, {code} END AS code, {sign} AS callsign FROM kinds),
roster AS (SELECT id, string_agg(callsign || '/' || split_part(code, '/', 1) || '/' || kind, ',' ORDER BY k) AS roster,
  string_agg('  ' || CASE WHEN k = 0 THEN '[FOCAL]' ELSE '       ' END || ' ' || callsign || ' (' || split_part(code, '/', 1) || ', ' ||
    CASE split_part(code, '/', 2) {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in WAKES.items())} END || ', ' || kind || ')', chr(10) ORDER BY k) AS lines,
  '[' || string_agg('{{"aircraft_type":"' || split_part(code, '/', 1) || '","callsign":"' || callsign || '","operator_class":"' || kind || '","wake":"' || split_part(code, '/', 2) || '"}}', ',' ORDER BY k) || ']' AS craft_json FROM craft GROUP BY id),
s0 AS (SELECT d.id, icao, region, phase,
  lpad(CAST({_int(q('heading'), 1, 36)} AS VARCHAR), 2, '0') || {_pick(q('side'), c.runway_suffix_weights)} AS runway,
  CASE WHEN phase NOT IN ('ground', 'ramp') AND NOT {q('nosid')} < {c.sid_star_none_chance} THEN {letters} || CAST({_int(q('sid'), 1, 9)} AS VARCHAR) END AS sid_star,
  {_squawk(q('squawk'))} AS squawk, time_of_day, traffic_density, event, f.callsign, split_part(f.code, '/', 1) AS aircraft_type, split_part(f.code, '/', 2) AS wake, f.kind AS operator_class,
  n_aircraft, starts_with(event, 'emergency_') AS is_emergency, phase IN ('ground', 'tower', 'approach', 'center') AS is_towered, roster.roster, roster.lines,
  {_int(q('direction'), *w.wind_dir_deg)} AS wind_dir_deg, CASE {_pick(q('windy'), {str(k): b['weight'] for k, b in enumerate(w.wind_kt_buckets)})} {wind} END AS wind_kt,
  CASE WHEN vmc_imc = 'VMC' THEN CASE WHEN {q('cloud')} < {w.vmc_ceiling_chance} THEN {_int(q('ceiling'), *w.vmc_ceiling_ft)} END ELSE {_int(q('ceiling'), *w.imc_ceiling_ft)} END AS ceiling_ft, vmc_imc,
  round((CASE phase {band(0)} END) + {q('frequency')} * ((CASE phase {band(1)} END) - (CASE phase {band(0)} END)), 2) AS mhz,
  CASE WHEN vmc_imc = 'VMC' THEN round({between(q('vis'), *w.vmc_vis_sm)}, 1) ELSE round({between(q('vis'), *w.imc_vis_sm)}, 2) END AS vis, round({between(q('altimeter'), *w.altimeter_inhg)}, 2) AS inhg
  , craft_json FROM d JOIN many USING (id) JOIN roster USING (id) JOIN craft f ON f.id = d.id AND f.k = 0),
s AS (SELECT * EXCLUDE (craft_json), sha1('{{"aircraft":' || craft_json || ',"event":"' || event || '","frequency_mhz":' || CAST(mhz AS VARCHAR) || ',"icao":"' || icao || '","phase":"' || phase || '","region":"' || region
  || '","runway":"' || runway || '","sid_star":' || coalesce('"' || sid_star || '"', 'null') || ',"squawk":"' || squawk || '","time_of_day":"' || time_of_day || '","traffic_density":"' || traffic_density
  || '","weather":{{"altimeter_inhg":' || CAST(inhg AS VARCHAR) || ',"ceiling_ft":' || coalesce(CAST(ceiling_ft AS VARCHAR), 'null') || ',"vis_sm":' || CAST(vis AS VARCHAR) || ',"vmc_imc":"' || vmc_imc
  || '","wind_dir_deg":' || wind_dir_deg || ',"wind_kt":' || wind_kt || '}}}}') AS scenario_id FROM s0)"""


_REQUEST = r"""'Generate an ATC exchange for this scenario. Plaintext only, one `SPEAKER: utterance` per line.' || chr(10) || chr(10) || concat_ws(chr(10),
  'Airport (ICAO): ' || icao, 'Phase: ' || phase, printf('Frequency: %.2f MHz', mhz), 'Time of day: ' || time_of_day, 'Traffic density: ' || traffic_density,
  'Weather: ' || vmc_imc || printf(', wind %03d at %d kt, visibility ', wind_dir_deg, wind_kt) || CAST(vis AS VARCHAR) || ' SM, '
    || CASE WHEN ceiling_ft IS NULL THEN 'ceiling unlimited' ELSE 'ceiling ' || ceiling_ft || ' ft' END || printf(', altimeter %.2f', inhg),
  '', 'Aircraft on this frequency:' || chr(10) || lines, '', 'Focal aircraft: ' || callsign || ' (' || aircraft_type || ')', 'Focal runway in use: ' || runway,
  'Focal SID/STAR: ' || coalesce(sid_star, 'none'), 'Focal assigned squawk: ' || squawk, 'Event (centered on focal aircraft): ' || event)"""

_DOCS_FIRST = "SELECT source, min(doc_id) AS doc_id FROM documents WHERE n_chars IS NULL OR n_chars BETWEEN 200 AND 5000 GROUP BY source"


def oracle_sql() -> dict[str, str]:
    c, people = config.load(), "SELECT row_number() OVER () - 1 AS id FROM customer"
    tiers = ", ".join(f"('{k}', {c.tier_weights[str(v)]})" for k, v in c.airport_tiers.items())
    points = """
SELECT event_type, ok, n AS count, wall, CASE WHEN wall > 0 THEN round(ok::DECIMAL(20, 6) / wall, 3) ELSE 0 END::DOUBLE AS rate_per_sec, CASE WHEN n > 0 THEN round(100 * (n - ok)::DECIMAL(20, 6) / n, 2) ELSE 0 END::DOUBLE AS fail_pct
FROM (SELECT event_type, count(*) FILTER (event_id % 7 <> 0) AS ok, count(*) AS n, sum(event_id % 100)::BIGINT AS wall FROM events GROUP BY event_type)"""
    return {
        "parse_turns": f"WITH {_LINES} SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY k) - 1 AS line, speaker, text FROM m",
        "validate_transcripts": f"WITH {_JUDGED} SELECT conv_id, n_turns, error FROM v",
        "transcript_outcomes": f"WITH {_JUDGED} SELECT count(*) FILTER (error IS NULL) AS ok, count(*) FILTER (error IS NOT NULL) AS failed, count(*) FILTER (starts_with(error, 'only')) AS too_few FROM v",
        "distinct_speakers": f"WITH {_LINES} SELECT DISTINCT conv_id, upper(speaker) AS speaker FROM m",
        "first_per_speaker": f"SELECT d.doc_id, d.source, d.n_chars FROM documents d JOIN ({_DOCS_FIRST}) f USING (doc_id)",
        "longest_per_speaker": """
SELECT doc_id, source, n_chars, first_ord FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r, min(doc_id) OVER (PARTITION BY source) AS first_ord
  FROM documents WHERE n_chars BETWEEN 100 AND 3000) WHERE r = 1""",
        "accept_clip": """
WITH e AS (SELECT vec_id, n_chars / 50.0 AS s, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)) AS r FROM embeddings JOIN documents ON doc_id = vec_id)
SELECT vec_id, coalesce(s BETWEEN 10 AND 60 AND r > 0 AND 20 * log10(CASE WHEN r > 0 THEN r END) >= -20, false) AS accepted FROM e""",
        "voice_ids": "SELECT doc_id, substr(sha1(source || ':' || CAST(doc_id AS VARCHAR)), 1, 12) AS voice_id FROM documents",
        "canonical_ids": """SELECT p_partkey, sha1('{"brand":"' || p_brand || '","name":"' || p_name || '","size":' || p_size || '}') AS part_id FROM part""",
        "resume_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "resume_offset": "SELECT doc_id FROM (SELECT unnest(range(least(100, m), m)) AS doc_id FROM (SELECT coalesce(max(doc_id), 0) + 1 AS m FROM documents)) WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "region_lookup": """
SELECT c_custkey, coalesce(r_name, 'other') AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
        "region_rule": f"""
WITH known(country, region) AS (VALUES {_countries()}), p AS (SELECT translate(CAST(c_custkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS icao, substr(n_name, 1, 2) AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT icao, coalesce(region, 'other') AS region FROM p LEFT JOIN known USING (country) WHERE length(icao) = 4""",
        "country_regions": f"""
WITH known(country, region) AS (VALUES {_countries()}), s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 <> 0 THEN substr(n_name, 1, 2) WHEN s_suppkey % 2 = 0 THEN lower(substr(n_name, 1, 2)) END AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, s.country, coalesce(region, 'other') AS region FROM s LEFT JOIN known ON known.country = s.country""",
        "tier_weights": f"""
WITH t(icao, weight) AS (VALUES {tiers}), air(icao, country) AS (VALUES {_airports()}),
a AS (SELECT icao, row_number() OVER (ORDER BY icao) - 1 AS place, count(*) OVER () AS n FROM (SELECT icao FROM air UNION SELECT icao FROM t UNION VALUES ('YYYY'), ('ZZZZ')))
SELECT icao, coalesce(weight, {c.tier_weights['default']})::DOUBLE AS weight, c_custkey FROM a LEFT JOIN t USING (icao) LEFT JOIN customer ON c_custkey % n = place""",
        "operator_multimap": """
WITH m AS (SELECT r_name AS c, n_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT substr(n_name, 1, 1), n_name FROM nation)
SELECT c AS operator_class, count(*) AS n_aircraft, string_agg(n_name, ',' ORDER BY n_name) AS members FROM m GROUP BY c""",
        "allowed_regions": "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))",
        "scenario_sample": f"WITH {_scenarios()} SELECT * EXCLUDE (lines, mhz, vis, inhg), round(mhz * 100)::BIGINT AS frequency_khz10, round(vis * 100)::BIGINT AS vis_sm_100, round(inhg * 100)::BIGINT AS altimeter_100 FROM s",
        "prompt_briefing": f"WITH {_scenarios()} SELECT id, 'Aircraft on this frequency:' || chr(10) || lines AS roster, 2::BIGINT AS n_messages, 'system,user' AS roles, {_REQUEST} AS request FROM s",
        "event_mix": f"SELECT event, count(*) AS n FROM (SELECT {_pick(_u(repr('event'), 'o_orderkey'), c.event_weights)} AS event FROM orders) GROUP BY event",
        "squawk_codes": f"SELECT o_orderkey, {_squawk(_u(repr('squawk'), 'o_orderkey'))} AS squawk FROM orders",
        "weighted_choice": f"""
WITH p AS (SELECT p_partkey, sum(p_size::DOUBLE) OVER (ORDER BY p_partkey) - p_size AS low, sum(p_size::DOUBLE) OVER (ORDER BY p_partkey) AS high, sum(p_size::DOUBLE) OVER () AS total FROM part),
o AS (SELECT o_orderkey, {_u(repr('part'), 'o_orderkey')} * (SELECT max(total) FROM p) AS x FROM orders)
SELECT o_orderkey, p_partkey FROM o JOIN p ON x >= low AND x < high""",
        "notice_report": """
SELECT source, count(*) AS voices, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS licenses, string_agg(DISTINCT substr(source, 1, 4), ', ' ORDER BY substr(source, 1, 4)) AS attributions FROM documents GROUP BY source""",
        "target_limit": """
WITH r AS (SELECT doc_id, source, lang, (list_position(['fr', 'en', 'es', 'de'], lang) - 1) * 281474976710656 + doc_id AS ord, n_chars BETWEEN 500 AND 4000 AS ok,
  doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS there FROM documents WHERE lang IN ('fr', 'en', 'es', 'de')),
d AS (SELECT *, ord = min(ord) FILTER (ok) OVER (PARTITION BY lang, source) AS isdec FROM r),
c AS (SELECT *, coalesce(isdec, false) AND NOT there AS cand FROM d),
k AS (SELECT *, coalesce(sum(cand::INT) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 30 AS processed FROM c)
SELECT doc_id, source, lang, cand AND processed AS kept, processed AND NOT coalesce(isdec, false) AS skipped FROM k""",
        "shard_assignment": """
SELECT shard_id, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard_id FROM documents) GROUP BY shard_id""",
        "failure_replay": """
SELECT event_type, count(*) FILTER (ok) AS readable, count(*) FILTER (NOT ok) AS corrupt FROM (SELECT event_type, json_valid(CASE WHEN event_id % 10 = 0 THEN substr(props, 2) ELSE props END) AS ok FROM events) GROUP BY event_type""",
        "benchmark_points": points,
        "benchmark_best": f"SELECT event_type AS best, rate_per_sec FROM ({points}) ORDER BY rate_per_sec DESC, event_type LIMIT 1",
        "domain_errors": """
WITH r AS (SELECT unnest([CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status' END, CASE WHEN NOT o_totalprice BETWEEN 1000 AND 300000 THEN 'price' END,
  CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-') THEN 'priority' END]) AS rule FROM orders)
SELECT rule, count(*) AS n FROM r WHERE rule IS NOT NULL GROUP BY rule""",
        "scenario_errors": """
WITH r AS (SELECT o_orderkey AS id FROM orders),
b AS (SELECT id, unnest([CASE WHEN id % 5 = 0 THEN 'squawk' END, CASE WHEN id % 7 = 0 THEN 'icao' END, CASE WHEN id % 11 = 0 THEN 'phase' END, CASE WHEN id % 13 = 0 THEN 'weather.wind_kt' END,
  CASE WHEN id % 17 = 0 THEN 'n_aircraft' END, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 AND id % 11 <> 0 AND id % 13 <> 0 AND id % 17 <> 0 THEN 'none' END]) AS rule FROM r)
SELECT rule, count(*) AS n FROM b WHERE rule IS NOT NULL GROUP BY rule""",
        "voice_records": """
SELECT substr(sha1(source || ':' || CAST(doc_id AS VARCHAR)), 1, 12) AS voice_id, source, CAST(doc_id AS VARCHAR) AS source_speaker_id, source || '-' || CAST(doc_id AS VARCHAR) AS source_clip_id,
  n_chars / 16.0::DOUBLE AS duration_s, CASE WHEN length(source) = 4 THEN 'pool' || CAST(CAST(substr(source, 4) AS INT) % 3 AS VARCHAR) ELSE '' END AS sub_pool, lang AS language FROM documents""",
        "source_order": """
SELECT (list_position(['fr', 'en', 'es', 'de'], lang) - 1) * 281474976710656 + doc_id AS ord, doc_id, lang FROM documents WHERE lang IN ('fr', 'en', 'es', 'de')""",
        "outcome_windows": """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_id % 3 <> 0) AS ok, count(*) FILTER (event_id % 3 = 0) AS failed FROM events GROUP BY day""",
        "generate_stub": f"""WITH {_scenarios(people)}, a AS (SELECT scenario_id, substr(sha1({_REQUEST}), 1, 2) < '1a' AS prose FROM s)
SELECT scenario_id, CASE WHEN prose THEN 'TranscriptParseError' ELSE 'ok' END AS outcome, CASE WHEN prose THEN 0 ELSE 4 END::BIGINT AS n_turns FROM a""",
        "run_report": f"""WITH {_scenarios(people)}, a AS (SELECT id, substr(sha1({_REQUEST}), 1, 2) < '1a' AS prose FROM s),
totals AS (SELECT count(*) FILTER (NOT prose) AS ok, count(*) FILTER (prose) AS bad, count(DISTINCT id // {RUN_SHARD}) FILTER (NOT prose) AS shards FROM a)
SELECT unnest(['shards', 'n_rows', 'manifest_rows', 'last_shard', 'failures', 'again_failed']) AS what, unnest([shards, ok, ok, shards - 1, bad, bad])::BIGINT AS n FROM totals""",
        "fingerprints": """SELECT o_orderkey, substr(sha1('{"config_name":"us","model":"' || o_orderpriority || '","prompt_version":"p","regions":[' || CASE WHEN o_orderkey % 2 = 1 THEN '"canada",' ELSE '' END
  || '"us"],"seed":' || o_orderkey || ',"taxonomy_version":"t1","weighter_name":"tier_v1"}'), 1, 16) AS fingerprint FROM orders""",
        "custom_weights": "SELECT p_brand AS icao, arg_max(p_size, p_partkey)::DOUBLE AS weight FROM part GROUP BY p_brand",
        "corpus_order": """
SELECT row_number() OVER (ORDER BY list_position(['fr', 'en', 'es', 'de'], lang), doc_id) - 1 AS place, doc_id, lang FROM documents WHERE lang IN ('fr', 'en', 'es', 'de')""",
        "voice_pool": """
WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) || '-' || CAST(vec_id % 7 AS VARCHAR) AS speaker, len(embedding) AS n, len(embedding) / 4.0 AS s,
  sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)) AS r FROM embeddings),
k AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY vec_id) AS place FROM e WHERE s BETWEEN 1 AND 60 AND r > 0 AND 20 * log10(r) >= -20)
SELECT substr(sha1('emb:' || speaker), 1, 12) AS voice_id, CAST(vec_id AS VARCHAR) AS source_clip_id, 'clip ' || vec_id AS text, 4 * n AS n_bytes FROM k WHERE place = 1 ORDER BY vec_id LIMIT 15""",
        "derived_flags": """
WITH i AS (SELECT l_orderkey, list({'n': l_linenumber, 'callsign': strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), 'aircraft_type': l_linestatus, 'wake': l_returnflag} ORDER BY l_linenumber, l_shipdate, l_linestatus, l_returnflag) AS a FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, a[1].callsign AS callsign, a[1].aircraft_type AS aircraft_type, a[1].wake AS wake, a[1].wake AS operator_class, len(a)::BIGINT AS n_aircraft, o_orderpriority = '1-URGENT' AS is_emergency, l_orderkey % 5 <> 4 AS is_towered
FROM i JOIN orders ON l_orderkey = o_orderkey""",
    }
