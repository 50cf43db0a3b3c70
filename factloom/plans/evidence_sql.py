"""DuckDB SQL of the evidence queries: one chain of common table expressions, of which each query reads the end it needs."""

from __future__ import annotations

_CHAIN = r"""
ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS k FROM events),
obs AS (SELECT 'EV-' || lpad(CAST(event_id AS VARCHAR), 7, '0') AS obs_id, event_type AS source,
    'k=' || k || '; cents=' || CAST(round(value * 100) AS BIGINT) || '; user=' || user_id AS raw_payload,
    CASE WHEN k % 10 = 7 THEN '' ELSE lpad(CAST(k AS VARCHAR), 2, '0') || ':' || lpad(CAST(user_id // 150 AS VARCHAR), 2, '0') || ':' || strftime(ts, '%d') || ':' || strftime(ts, '%H') || ':00:01' END AS mac,
    CASE WHEN user_id % 10 = 3 THEN '' ELSE ' U' || user_id || '-' || strftime(ts, '%Y-%m-%d') || ' ' END AS hostname,
    CASE k % 4 WHEN 0 THEN '80, 443' WHEN 1 THEN '554,80' WHEN 2 THEN '22,161,,' ELSE '' END AS open_ports, k, user_id, strftime(ts, '%Y-%m-%d') AS day FROM ev),
m AS (SELECT * FROM obs WHERE source <> 'signup'),
raw AS (
  SELECT obs_id, source, 'field' AS kind, 'tier' AS key, regexp_extract(raw_payload, 'k=(\d)', 1) AS v, source AS wg, 'extraction.yaml#k_tier' AS rule_id, instr(raw_payload, 'k=') + 1 AS s FROM m WHERE source <> 'error'
  UNION ALL SELECT obs_id, source, 'field', 'tier', regexp_extract(raw_payload, 'user=(\d)', 1), source, 'extraction.yaml#user_tier', instr(raw_payload, 'user=') + 4 FROM m WHERE source = 'purchase'
  UNION ALL SELECT obs_id, source, 'field', 'item', regexp_extract(raw_payload, 'k=(\d+)', 1), source, 'extraction.yaml#k_item', instr(raw_payload, 'k=') + 1 FROM m WHERE source <> 'error'
  UNION ALL SELECT obs_id, source, 'field', 'amount', regexp_extract(raw_payload, 'cents=(\d+)', 1), source, 'extraction.yaml#cents', instr(raw_payload, 'cents=') + 5 FROM m WHERE source IN ('view', 'purchase')
  UNION ALL SELECT obs_id, source, 'link_basis', 'serial', regexp_extract(raw_payload, 'user=(1\d*)', 1), source, 'extraction.yaml#error_user', instr(raw_payload, 'user=') + 4 FROM m WHERE source = 'error' AND user_id::VARCHAR LIKE '1%'
  UNION ALL SELECT obs_id, source, 'link_basis', 'mac', mac, 'structured_column', 'extraction.yaml#mac', NULL FROM m WHERE mac <> ''
  UNION ALL SELECT obs_id, source, 'link_basis', 'hostname_token', hostname, 'structured_column', 'extraction.yaml#hostname', NULL FROM m WHERE hostname <> ''
  UNION ALL SELECT obs_id, source, 'field', 'tier', 'silver', 'oui', 'extraction.yaml#oui', NULL FROM m WHERE mac <> '' AND k BETWEEN 10 AND 35 AND substr(mac, 4, 5) = '00:01'
  UNION ALL SELECT obs_id, source, 'field', 'role', 'camera', 'port_signature', 'extraction.yaml#port_signatures.camera', NULL FROM m WHERE k % 4 = 1
  UNION ALL SELECT obs_id, source, 'field', 'role', 'web server', 'port_signature', 'extraction.yaml#port_signatures.web', NULL FROM m WHERE k % 4 = 0
  UNION ALL SELECT obs_id, source, 'field', 'role', 'switch', 'port_signature', 'extraction.yaml#port_signatures.switch', NULL FROM m WHERE k % 4 = 2),
ext AS (SELECT obs_id, source, kind AS target_kind, key AS target,
    CASE WHEN key = 'mac' THEN upper(replace(v, ':', '')) WHEN key = 'hostname_token' THEN lower(trim(v))
      WHEN key = 'tier' THEN CASE v WHEN '1' THEN 'bronze' WHEN '2' THEN 'silver' WHEN '3' THEN 'gold' WHEN '4' THEN 'bronze' ELSE v END ELSE v END AS value,
    wg AS witness_group, rule_id, CAST(s AS INT) AS "start", CAST(s + length(v) AS INT) AS "end" FROM raw),
grp AS (SELECT obs_id, target_kind AS kind, target AS key, value, list_sort(list(DISTINCT witness_group)) AS g, list_sort(list(DISTINCT source)) AS src FROM ext GROUP BY ALL),
allg AS (SELECT obs_id, target_kind AS kind, target AS key, list(DISTINCT witness_group) AS ag FROM ext GROUP BY ALL),
w(grp_name, w) AS (VALUES ('click', 0.55::DOUBLE), ('view', 0.7), ('purchase', 0.85), ('error', 0.3), ('oui', 0.5), ('port_signature', 0.25), ('structured_column', 0.8)),
base AS (SELECT obs_id, target_kind AS kind, target AS key, value, max(w) AS b FROM ext JOIN w ON witness_group = grp_name GROUP BY ALL),
con AS (SELECT grp.*, list_sort(list_filter(ag, lambda x: NOT list_contains(g, x))) AS c FROM grp JOIN allg USING (obs_id, kind, key)),
cl AS (SELECT con.*, round(greatest(0, least(1, b + CASE WHEN len(g) < 2 THEN 0 ELSE (CASE WHEN kind = 'field' THEN 0.3::DOUBLE ELSE 0.2 END) * (1 - pow(0.5::DOUBLE, len(g) - 1)) END
      - CASE WHEN kind = 'field' THEN least(0.4::DOUBLE, 0.1::DOUBLE * len(c)) ELSE least(0.6::DOUBLE, 0.25::DOUBLE * len(c)) END)), 6) AS weight,
    CASE WHEN key = 'tier' THEN value IN ('bronze', 'silver', 'gold') WHEN key = 'role' THEN value IN ('camera', 'web server', 'switch') ELSE true END AS in_vocab
  FROM con JOIN base USING (obs_id, kind, key, value)),
ident AS (SELECT *, CASE key WHEN 'mac' THEN 0 WHEN 'serial' THEN 1 ELSE 2 END AS rnk FROM cl WHERE kind = 'link_basis'),
pairs AS (SELECT x.obs_id AS a, y.obs_id AS b, x.key AS basis, x.value, least(x.weight, y.weight) AS weight, least(x.weight, y.weight) >= 0.55 AS accepted FROM ident x JOIN ident y ON x.key = y.key AND x.value = y.value AND x.obs_id < y.obs_id),
hubs AS (SELECT key, value, min(obs_id) AS hub, count(*) AS n FROM ident WHERE weight >= 0.55 GROUP BY ALL HAVING count(*) > 1),
hubbed AS (SELECT i.obs_id, i.key, h.hub, h.n, i.value, i.weight, i.rnk FROM ident i JOIN hubs h USING (key, value) WHERE i.weight >= 0.55),
both_ways AS (SELECT hub AS a, obs_id AS b FROM hubbed WHERE hub <> obs_id UNION SELECT obs_id, hub FROM hubbed WHERE hub <> obs_id),
reach(n, x) AS (SELECT obs_id, obs_id FROM obs UNION SELECT reach.n, e.b FROM reach JOIN both_ways e ON reach.x = e.a),
part AS (SELECT n AS obs_id, min(x) AS part FROM reach GROUP BY n),
ids AS (SELECT part, 'E-' || substr(sha256(string_agg(obs_id, '|' ORDER BY obs_id)), 1, 12) AS entity_id FROM part GROUP BY part),
ent AS (SELECT obs_id, entity_id FROM part JOIN ids USING (part)),
crossing AS (SELECT x.hub AS h1, y.hub AS h2, x.value AS v1, y.value AS v2 FROM hubbed x JOIN hubbed y USING (obs_id) WHERE x.key = 'mac' AND y.key = 'hostname_token' GROUP BY x.hub, y.hub, x.value, y.value, x.n, y.n HAVING count(*) < least(x.n, y.n)),
confl AS (SELECT x.obs_id, 'cross_basis_conflict: mac->' || x.hub || ',hostname_token->' || y.hub || '; precedence_winner=mac' AS conflict_detail
  FROM hubbed x JOIN hubbed y USING (obs_id) JOIN crossing c ON x.value = c.v1 AND y.value = c.v2 WHERE x.key = 'mac' AND y.key = 'hostname_token'),
made AS (SELECT obs_id, arg_min(key, (-weight, rnk, value)) AS b, max(weight) AS w FROM hubbed GROUP BY obs_id),
own_id AS (SELECT obs_id, arg_min(key, (-weight, rnk, value)) AS b, max(weight) AS w FROM ident GROUP BY obs_id),
mem AS (SELECT obs_id, entity_id, coalesce(made.b, own_id.b, 'none') AS link_basis, coalesce(made.w, own_id.w, 0.0) AS link_weight, conflict_detail IS NULL AS basis_agreement, conflict_detail
  FROM ent LEFT JOIN made USING (obs_id) LEFT JOIN own_id USING (obs_id) LEFT JOIN confl USING (obs_id)),
fc AS (SELECT entity_id, key AS field, value, weight, g, in_vocab FROM cl JOIN ent USING (obs_id) WHERE kind = 'field'),
val AS (SELECT entity_id, field, value, max(weight) AS weight, list_sort(list_distinct(flatten(list(g)))) AS g, bool_and(in_vocab) AS iv FROM fc GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY entity_id, field ORDER BY weight DESC, value) AS r, count(*) OVER (PARTITION BY entity_id, field) AS n FROM val WHERE iv),
win AS (SELECT * FROM rk WHERE r = 1),
against AS (SELECT v.entity_id, v.field, list_filter(list_distinct(flatten(list(v.g))), lambda x: NOT list_contains(any_value(win.g), x)) AS c FROM val v JOIN win ON v.entity_id = win.entity_id AND v.field = win.field AND v.value <> win.value GROUP BY ALL),
gw AS (SELECT entity_id, field, max(w.w) AS b FROM (SELECT entity_id, field, unnest(g) AS grp_name FROM win) JOIN w USING (grp_name) GROUP BY ALL),
every AS (SELECT DISTINCT entity_id, f.field FROM ent, (VALUES ('tier'), ('item'), ('amount'), ('role')) f(field)),
res AS (SELECT e.entity_id, e.field,
    CASE WHEN win.value IS NULL THEN CASE e.field WHEN 'tier' THEN 'Unknown' WHEN 'role' THEN 'unknown' ELSE '' END WHEN e.field = 'amount' AND win.n > 1 THEN 'undecidable' ELSE win.value END AS value,
    CASE WHEN win.value IS NULL OR e.field = 'amount' AND win.n > 1 THEN 0.0 ELSE round(greatest(0, least(1, gw.b + CASE WHEN len(win.g) < 2 THEN 0 ELSE 0.3::DOUBLE * (1 - pow(0.5::DOUBLE, len(win.g) - 1)) END - least(0.4::DOUBLE, 0.1::DOUBLE * len(coalesce(a.c, []))))), 6) END AS confidence,
    CASE WHEN e.field = 'amount' AND win.n > 1 THEN NULL ELSE nx.value END AS runner_up,
    CASE WHEN e.field = 'amount' AND win.n > 1 THEN 0.0 ELSE coalesce(round(nx.weight, 6), 0.0) END AS runner_up_weight,
    CASE WHEN win.value IS NULL OR e.field = 'amount' AND win.n > 1 THEN [] ELSE win.g END AS wgs
  FROM every e LEFT JOIN win USING (entity_id, field) LEFT JOIN gw USING (entity_id, field) LEFT JOIN against a USING (entity_id, field) LEFT JOIN rk nx ON nx.entity_id = e.entity_id AND nx.field = e.field AND nx.r = 2),
ownf AS (SELECT obs_id, key AS field, value, weight FROM cl WHERE kind = 'field' AND in_vocab),
bestf AS (SELECT obs_id, field, max((weight, value)) AS best FROM (SELECT obs_id, field, weight, value FROM ownf) GROUP BY ALL),
ob AS (SELECT mem.obs_id, mem.entity_id, res.field,
    CASE WHEN res.value = 'undecidable' AND best IS NOT NULL THEN best[2] ELSE res.value END AS value,
    CASE WHEN res.value IN ('', 'Unknown', 'unknown') THEN 0.0 WHEN res.value = 'undecidable' THEN coalesce(best[1], 0.0) WHEN o.weight IS NOT NULL THEN o.weight ELSE round(res.confidence * greatest(link_weight, 0) * 0.75::DOUBLE, 6) END AS confidence,
    CASE WHEN res.value IN ('', 'Unknown', 'unknown') THEN 'unknown' WHEN res.value = 'undecidable' THEN CASE WHEN best IS NULL THEN 'unknown' ELSE 'direct' END WHEN o.weight IS NOT NULL THEN 'direct' ELSE 'propagated' END AS provenance
  FROM mem JOIN res USING (entity_id) LEFT JOIN bestf bf ON bf.obs_id = mem.obs_id AND bf.field = res.field LEFT JOIN ownf o ON o.obs_id = mem.obs_id AND o.field = res.field AND o.value = res.value),
roll AS (SELECT entity_id, coalesce(round(count(*) FILTER (confidence > 0) / nullif(sum(1 / confidence) FILTER (confidence > 0), 0), 6), 0.0) AS confidence,
    round(greatest(0, least(1, coalesce(0.5::DOUBLE * avg(greatest(0, confidence - runner_up_weight) / confidence) FILTER (confidence > 0) + 0.3::DOUBLE * avg(least(1, greatest(0, len(wgs) - 1) / 2.0::DOUBLE)) FILTER (confidence > 0) + 0.2::DOUBLE * avg(CASE WHEN coalesce(runner_up, '') <> '' THEN 0 ELSE 1 END) FILTER (confidence > 0), 0))), 6) AS stability FROM res GROUP BY entity_id),
rw AS (SELECT obs_id, entity_id, max(value) FILTER (field = 'tier') AS tier, max(provenance) FILTER (field = 'tier') AS tier_provenance, max(value) FILTER (field = 'item') AS item, max(provenance) FILTER (field = 'item') AS item_provenance,
    max(value) FILTER (field = 'amount') AS amount, max(provenance) FILTER (field = 'amount') AS amount_provenance, max(value) FILTER (field = 'role') AS role, max(provenance) FILTER (field = 'role') AS role_provenance FROM ob GROUP BY ALL),
tp AS (SELECT obs_id, key AS field, arg_min(value, (-weight, value)) AS top1_claim FROM cl WHERE kind = 'field' GROUP BY ALL),
lw AS (SELECT obs_id, CASE WHEN k % 10 = 7 THEN '' WHEN k < 20 THEN 'bronze' WHEN k < 50 THEN 'silver' ELSE 'gold' END AS tier, CAST(k AS VARCHAR) AS item, CASE WHEN source = 'click' THEN '' ELSE regexp_extract(raw_payload, 'cents=(\d+)', 1) END AS amount,
    CASE k % 4 WHEN 0 THEN 'web server' WHEN 1 THEN 'camera' WHEN 2 THEN 'switch' ELSE '' END AS role, user_id || '|' || day AS entity_id, CASE k % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence, k FROM obs),
lab AS (SELECT obs_id, 'field' AS key_type, key, value, confidence AS labeler_certainty, 'proposed' AS status FROM (SELECT obs_id, confidence, unnest(['tier', 'item', 'amount', 'role']) AS key, unnest([tier, item, amount, role]) AS value FROM lw) WHERE value <> ''),
outc AS (SELECT lab.obs_id, lab.key, lab.value AS expected, ob.value AS actual, CASE WHEN ob.value <> 'undecidable' THEN ob.value = lab.value END AS correct, ob.provenance, res.confidence AS field_confidence, coalesce(top1_claim, '') AS top1_claim, labeler_certainty, roll.confidence, roll.stability
  FROM lab JOIN ob ON ob.obs_id = lab.obs_id AND ob.field = lab.key JOIN res ON res.entity_id = ob.entity_id AND res.field = lab.key JOIN roll ON roll.entity_id = ob.entity_id LEFT JOIN tp ON tp.obs_id = lab.obs_id AND tp.field = lab.key),
known AS (SELECT * FROM outc WHERE correct IS NOT NULL)
"""


def _query(body: str) -> str:
    return f"WITH RECURSIVE {_CHAIN.strip()}\n{body}"


def _accuracy(metric: str, hit: str, of: str) -> str:
    return f"SELECT '{metric}' AS metric, key AS scope, round(count(*) FILTER ({hit}) / greatest(count(*) FILTER ({of}), 1), 6) AS value, count(*) FILTER ({of}) AS n FROM known GROUP BY key"


_HASHED = ("hostname", "mac", "obs_id", "open_ports", "raw_payload", "source")
_LABELS = """SELECT obs_id, key, value, 'payload_inference' AS basis, 4 AS tier FROM lab
  UNION ALL SELECT obs_id, 'item', item || 'x', 'physical_inspection', 1 FROM lw WHERE k % 5 = 0
  UNION ALL SELECT obs_id, 'item', item, 'asset_inventory', 2 FROM lw WHERE k % 5 <= 1
  UNION ALL SELECT obs_id, 'item', item || 'y', 'asset_inventory', 2 FROM lw WHERE k % 5 = 1
  UNION ALL SELECT obs_id, 'item', item, 'payload_inference', 4 FROM lw WHERE k % 5 = 2"""

_LONG = "lng AS (SELECT obs_id, key_type, key, value, status, 'payload_inference' AS label_basis, labeler_certainty FROM lab)"
_PACKET = "pk AS (SELECT obs_id FROM lng GROUP BY obs_id HAVING bool_or(labeler_certainty IN ('medium', 'low')))"
_HASH = f"'sha256:' || sha256({" || '|' || ".join(_HASHED)})"
_RETURNED = f"""ret AS (SELECT obs_id, CASE WHEN k % 7 = 1 THEN 'guess' ELSE 'field' END AS key_type, CASE WHEN k % 7 = 2 THEN 'colour' ELSE 'item' END AS key,
  CASE k % 7 WHEN 3 THEN ' ' WHEN 6 THEN k || 'z' ELSE CAST(k AS VARCHAR) END AS value, k % 7 = 4 AS stale FROM obs WHERE k % 4 = 0),
judged AS (SELECT *, CASE WHEN obs_id NOT IN (SELECT obs_id FROM pk) THEN 'not in the packet' WHEN key_type = 'guess' THEN 'no declared kind of label' WHEN key = 'colour' THEN 'no declared key' WHEN trim(value) = '' THEN 'empty value' WHEN stale THEN 'stale obs_hash' END AS rejected FROM ret)"""
_LIFE = f", {_LONG}, {_PACKET}, {_RETURNED}"

SQL: dict[str, str] = {
    name: _query(body)
    for name, body in {
        "extractions": "SELECT * FROM ext",
        "unmapped_source": "SELECT obs_id, source FROM obs WHERE source = 'signup'",
        "no_extraction": "SELECT obs_id, source FROM m WHERE obs_id NOT IN (SELECT obs_id FROM ext)",
        "payload_gaps": """SELECT obs_id, source FROM obs WHERE obs_id NOT IN (SELECT obs_id FROM ext WHERE "start" IS NOT NULL)""",
        "claims_scored": "SELECT obs_id, kind, key, value, weight, array_to_string(g, '|') AS witness_groups, array_to_string(src, '|') AS sources, array_to_string(c, '|') AS conflicts, in_vocab FROM cl",
        "identity_edges": "SELECT * FROM pairs",
        "entity_components": "SELECT * FROM ent",
        "per_basis_components": "SELECT obs_id, key, hub AS part FROM hubbed",
        "membership": "SELECT * FROM mem",
        "resolved_fields": "SELECT entity_id, field, value, confidence, runner_up, runner_up_weight, array_to_string(wgs, '|') AS witness_groups FROM res",
        "observation_fields": "SELECT * FROM ob",
        "entity_rollup": "SELECT * FROM roll",
        "entities_wide": "SELECT entity_id, "
        + ", ".join(f"max(r.value) FILTER (field = '{f}') AS {f}, max(r.confidence) FILTER (field = '{f}') AS {f}_confidence" for f in ("tier", "item", "amount", "role"))
        + ", any_value(roll.confidence) AS confidence, any_value(stability) AS stability FROM res r JOIN roll USING (entity_id) GROUP BY entity_id",
        "resolutions_wide": "SELECT * FROM rw",
        "final_output": "SELECT obs_id, tier, item, CASE WHEN amount_provenance = 'direct' THEN amount ELSE '' END AS amount, role, entity_id, CASE WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END AS confidence FROM rw JOIN roll USING (entity_id)",
        "top1_claim": "SELECT * FROM tp",
        "vocab_reject_queue": "SELECT key, value, count(*) AS n, array_to_string(list_sort(list(obs_id))[1:3], '|') AS examples FROM cl WHERE kind = 'field' AND NOT in_vocab GROUP BY key, value",
        "outcomes": "SELECT * FROM outc",
        "accuracy": " UNION ALL ".join(
            (
                _accuracy("extraction_recall", "provenance = 'direct' AND correct", "true"),
                _accuracy("extraction_precision", "provenance = 'direct' AND correct", "provenance = 'direct'"),
                _accuracy("top1_claim_accuracy", "top1_claim <> '' AND top1_claim = expected", "top1_claim <> ''"),
                _accuracy("propagated_value_accuracy", "provenance = 'propagated' AND correct", "provenance = 'propagated'"),
            )
        ),
        "calibration": "SELECT printf('%.1f', least(floor(field_confidence * 10) / 10, 0.9)) AS bucket, round(abs(avg(correct::INT) - avg(field_confidence)), 6) AS value, count(*) AS n FROM known GROUP BY bucket",
        "accuracy_by_stability": "SELECT printf('%.1f', least(floor(stability * 10) / 10, 0.9)) AS bucket, round(avg(correct::INT), 6) AS value, count(*) AS n FROM known GROUP BY bucket",
        "stability_quadrants": " UNION ALL ".join(f"SELECT '{q}' AS quadrant, coalesce(round(avg(correct::INT) FILTER ({c}), 6), 0.0) AS value, count(*) FILTER ({c}) AS n FROM known" for q, c in (("high_conf_high_stab", "field_confidence >= 0.7 AND stability >= 0.7"), ("high_conf_low_stab", "field_confidence >= 0.7 AND stability < 0.7"))),
        "pairwise_quality": """, cells AS (SELECT lw.entity_id AS t, ent.entity_id AS p, count(*) AS n FROM lw JOIN ent USING (obs_id) GROUP BY ALL),
tpairs AS (SELECT sum(n * (n - 1) // 2) AS n FROM (SELECT sum(n) AS n FROM cells GROUP BY t)), ppairs AS (SELECT sum(n * (n - 1) // 2) AS n FROM (SELECT sum(n) AS n FROM cells GROUP BY p)), hits AS (SELECT sum(n * (n - 1) // 2) AS n FROM cells)
SELECT round(hits.n / greatest(ppairs.n, 1), 6) AS pairwise_precision, round(hits.n / greatest(tpairs.n, 1), 6) AS pairwise_recall, CAST(ppairs.n - hits.n AS BIGINT) AS false_merge_count, CAST(tpairs.n - hits.n AS BIGINT) AS false_split_count FROM hits, tpairs, ppairs""",
        "label_unpivot": "SELECT * FROM lab",
        "label_pairs": "SELECT x.obs_id AS a, y.obs_id AS b, CASE WHEN 'low' IN (x.confidence, y.confidence) THEN 'low' WHEN 'medium' IN (x.confidence, y.confidence) THEN 'medium' ELSE 'high' END AS labeler_certainty FROM lw x JOIN lw y ON x.entity_id = y.entity_id AND x.obs_id < y.obs_id",
        "label_precedence": f""", every_label AS ({_LABELS}), t AS (SELECT *, min(tier) OVER (PARTITION BY obs_id, key) AS best, count(*) OVER (PARTITION BY obs_id, key) AS n FROM every_label),
f AS (SELECT obs_id, key, count(*) AS top, count(DISTINCT value) AS vals, any_value(n) AS n FROM t WHERE tier = best GROUP BY ALL)
SELECT DISTINCT obs_id, 'field' AS key_type, key, value, CASE WHEN vals > 1 THEN 'disputed' WHEN top > 1 AND f.n = top THEN 'agreed' WHEN f.n > 1 THEN 'adjudicated' ELSE 'proposed' END AS status, basis AS label_basis, CASE WHEN vals > 1 THEN top ELSE 1 END AS labels FROM t JOIN f USING (obs_id, key) WHERE tier = best""",
        "label_transitivity": """, p AS (SELECT DISTINCT a, b FROM pairs WHERE accepted), e AS (SELECT a AS x, b AS y FROM p UNION SELECT b, a FROM p)
SELECT u.x, u.y AS a, v.y AS b FROM e u JOIN e v ON u.x = v.x AND u.y < v.y WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.a = u.y AND p.b = v.y)""",
        "label_vocabulary": f""", every_label AS ({_LABELS} UNION ALL SELECT obs_id, key, upper(value), 'vendor_doc', 3 FROM lab)
SELECT obs_id, key, value FROM every_label WHERE key = 'tier' AND value NOT IN ('bronze', 'silver', 'gold', 'Unknown') OR key = 'role' AND value NOT IN ('camera', 'web server', 'switch', 'unknown')""",
        "label_changes": "SELECT obs_id, key_type, key, value AS before, CASE WHEN key = 'amount' THEN NULL ELSE 'silver' END AS after, CASE WHEN key = 'amount' THEN 'removed' ELSE 'value_changed' END AS change FROM lab WHERE key = 'amount' OR value = 'gold'",
        "label_apply": f"""{_LIFE}
SELECT obs_id, key, value, status, label_basis, NULL AS change, NULL AS refused FROM lng WHERE key IN ('tier', 'amount')
UNION ALL SELECT l.obs_id, l.key, coalesce(j.value, l.value), CASE WHEN j.value IS NULL THEN l.status ELSE 'adjudicated' END, CASE WHEN j.value IS NULL THEN l.label_basis ELSE 'physical_inspection' END,
  CASE WHEN j.value IS NULL THEN NULL WHEN j.value <> l.value THEN 'value_changed' ELSE 'provenance_upgraded' END, NULL FROM lng l LEFT JOIN (SELECT * FROM judged WHERE rejected IS NULL) j USING (obs_id) WHERE l.key = 'item'
UNION ALL SELECT obs_id, key, value, CASE WHEN value = 'camera' THEN status ELSE 'adjudicated' END, CASE WHEN value = 'camera' THEN label_basis ELSE 'vendor_doc' END, CASE WHEN value <> 'camera' THEN 'provenance_upgraded' END, CASE WHEN value = 'camera' THEN 'disputed' END FROM lng WHERE key = 'role'""",
        "packet_stratum": f"{_LIFE} SELECT obs_id FROM pk",
        "packet": f"{_LIFE} SELECT obs_id, {_HASH} AS obs_hash, source, raw_payload, mac, hostname, open_ports FROM obs WHERE obs_id IN (SELECT obs_id FROM pk)",
        "returned_validation": f"{_LIFE} SELECT obs_id, key_type, key, value, 'low' AS labeler_certainty, 'second' AS labeled_by, rejected FROM judged",
        "payload_backlog": """SELECT obs_id, source, raw_payload FROM obs WHERE obs_id NOT IN (SELECT obs_id FROM ext WHERE "start" IS NOT NULL)""",
        "trace_orphans": "SELECT '' AS step_id, '' AS op, '' AS parent FROM ev WHERE false",
        "replay_claims": "SELECT obs_id, key, value, weight FROM cl",
        "replay_membership": "SELECT obs_id, entity_id, link_basis, basis_agreement FROM mem",
        "replay_differences": "SELECT '' AS part, '' AS item, '' AS problem FROM ev WHERE false",
        "obs_hash": f"SELECT obs_id, sha256({" || '|' || ".join(_HASHED)}) AS obs_hash FROM obs",
    }.items()
}
