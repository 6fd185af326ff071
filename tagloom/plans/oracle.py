"""SQL for another engine that answers each registered query from the columns the inputs were made of.

Decoded values come from the true library, building blocks and UMI of each read and from its error
code, not from decoding again; the search query is brute force over every position.
"""

from __future__ import annotations

from tagloom import derived as d


def dna(x: str, n: int) -> str:
    return "(" + " || ".join(f"substr('ACGT', (({x}) // {4**k}) % 4 + 1, 1)" for k in range(n)) + ")"


def tag(x: str) -> str:
    return f"repeat({dna(x, 4)}, 3)"


def sub(s: str, p: int, k: int) -> str:
    return f"(substr({s}, 1, {p - 1}) || translate(substr({s}, {p}, {k}), 'ACGT', 'CGTA') || substr({s}, {p + k}))"


def rc(s: str) -> str:
    return f"translate(reverse({s}), 'ACGTN', 'TGCAN')"


ERROR = "(l_orderkey // 40 + 3 * (l_partkey // 8) + 7 * (l_suppkey // 12) + 11 * l_linenumber) % 20"
TRUTH = f"""
base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    'r' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey AS read_id,
    CASE WHEN l_returnflag = 'R' THEN 'ctrl' ELSE 'tgt' END AS selection_id,
    (l_orderkey % 2)::INT AS rc, (l_suppkey % 3)::INT AS lib, (l_partkey % 8)::INT AS b1,
    (l_suppkey % 4)::INT AS b2, l_linenumber::INT AS b3, (l_orderkey % 40)::INT AS u,
    ({ERROR})::INT AS e
  FROM lineitem),
tags AS (
  SELECT *, {tag("b1+16")} AS t1, {tag("b2+64")} AS t2, {tag("b3+128")} AS t3, {tag("lib*41+27")} AS tl,
    repeat({dna("u*5+3", 6)}, 2) AS umi0 FROM base),
mutated AS (
  SELECT * EXCLUDE (t2, t3, tl),
    CASE WHEN e=3 THEN {sub("t2", 5, 1)} ELSE t2 END AS t2,
    CASE WHEN e=5 THEN {sub("tl", 3, 2)} WHEN e=17 THEN {sub("tl", 1, 3)} ELSE tl END AS tl,
    CASE WHEN e=13 THEN {sub("t3", 1, 2)} ELSE t3 END AS t3,
    CASE WHEN e=9 THEN {sub("umi0", 12, 1)} ELSE umi0 END AS umi FROM tags),
whole AS (
  SELECT *, CASE WHEN e=7 THEN 'T' ELSE '' END || '{d.PRIMER1}' || t1 || 'AA' || t2 || 'CC' || t3 || 'GG'
    || tl || umi || '{d.PRIMER2}' AS full_fwd FROM mutated),
fwds AS (
  SELECT *, CASE WHEN e=11 THEN repeat('{d.JUNK}', 8) WHEN e=15 THEN substr(full_fwd, 1, 71)
    ELSE full_fwd END AS fwd FROM whole),
truth AS (
  SELECT *, CASE WHEN rc=1 THEN {rc("fwd")} ELSE fwd END AS seq,
    CASE WHEN e IN (11, 17) THEN 'no_library' WHEN e=13 THEN 'bb3_unmatched' WHEN e=15 THEN 'umi_invalid'
      ELSE 'ok' END AS outcome,
    'L0' || lib AS library_id, b1 || ',' || b2 || ',' || b3 AS bb_ids FROM fwds)"""

# The same reads without any seeded error.
NO_ERRORS = TRUTH.replace(ERROR, "0")

DECODED = (
    TRUTH
    + """,
decoded AS (
  SELECT selection_id, read_id, CASE WHEN rc=1 AND outcome<>'no_library' THEN '-' ELSE '+' END AS strand,
    CASE WHEN outcome<>'no_library' THEN library_id END AS library_id,
    CASE WHEN outcome='ok' THEN bb_ids END AS bb_ids, CASE WHEN outcome='ok' THEN umi END AS umi,
    CASE WHEN outcome='no_library' THEN NULL WHEN e=5 THEN 2 ELSE 0 END::INT AS lib_mismatches, outcome
  FROM truth)"""
)

TALLY = (
    DECODED
    + """,
tally AS (
  SELECT selection_id, library_id, bb_ids, umi, count(*)::BIGINT AS c FROM decoded
  WHERE outcome='ok' GROUP BY ALL)"""
)

CLUSTERS = f"""
WITH RECURSIVE {TALLY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY selection_id, library_id, bb_ids ORDER BY c DESC, umi) AS rk
  FROM tally),
edges AS (
  SELECT a.selection_id, a.library_id, a.bb_ids, a.rk AS src, b.rk AS dst
  FROM ranked a JOIN ranked b USING (selection_id, library_id, bb_ids)
  WHERE hamming(a.umi, b.umi) = 1 AND a.c >= 2 * b.c - 1),
reach AS (
  SELECT selection_id, library_id, bb_ids, src, dst FROM edges
  UNION
  SELECT r.selection_id, r.library_id, r.bb_ids, r.src, e.dst FROM reach r JOIN edges e
    ON r.selection_id=e.selection_id AND r.library_id=e.library_id AND r.bb_ids=e.bb_ids AND r.dst=e.src),
absorbed AS (SELECT DISTINCT selection_id, library_id, bb_ids, dst FROM reach WHERE src < dst),
clustered AS (
  SELECT t.selection_id, t.library_id, t.bb_ids,
    (count(*) - count(a.dst))::BIGINT AS count, sum(t.c)::BIGINT AS raw_count, count(*)::BIGINT AS dedup_count
  FROM ranked t LEFT JOIN absorbed a ON t.selection_id=a.selection_id AND t.library_id=a.library_id
    AND t.bb_ids=a.bb_ids AND t.rk=a.dst
  GROUP BY ALL)"""

OUTCOMES = [
    "ok", "too_short", "no_library", "ambiguous_library", "bb1_unmatched", "bb1_ambiguous",
    "bb2_unmatched", "bb2_ambiguous", "bb3_unmatched", "bb3_ambiguous", "umi_invalid",
]
PIVOT = ", ".join(f"count(*) FILTER (outcome='{o}')::BIGINT AS {o}" for o in OUTCOMES)

NOISY = (
    TRUTH
    + """,
noisy AS (
  SELECT selection_id, read_id,
    CASE WHEN e=4 THEN translate(seq, 'A', 'N') WHEN e=2 THEN substr(seq, 1, 14) ELSE seq END AS seq,
    CASE WHEN e=1 THEN repeat('#', 40) || repeat('I', length(seq) - 40)
      WHEN e=6 THEN repeat('#', 30) || repeat('5', length(seq) - 30)
      WHEN e=2 THEN repeat('I', 14) ELSE repeat('I', length(seq)) END AS qual FROM truth),
scored AS (
  SELECT *, [ascii(x) - 33 FOR x IN string_split(qual, '')] AS q FROM noisy),
kept AS (
  SELECT * FROM scored WHERE length(seq) >= 15
    AND len([x FOR x IN string_split(seq, '') IF x = 'N']) <= 5
    AND len([x FOR x IN q IF x < 15]) * 100 <= length(seq) * 40)"""
)


def totals(table: str, stage: str) -> str:
    return f"""SELECT selection_id, '{stage}' AS stage, count(*)::BIGINT AS reads, sum(length(seq))::BIGINT AS bases,
    sum(len([x FOR x IN q IF x >= 20]))::BIGINT AS q20_bases,
    sum(len([x FOR x IN q IF x >= 30]))::BIGINT AS q30_bases FROM {table} GROUP BY ALL"""


COUNTS = (
    TRUTH
    + """,
counts AS (
  SELECT selection_id, library_id, bb_ids, count(DISTINCT umi)::BIGINT AS count,
    count(*)::BIGINT AS raw_count, count(DISTINCT umi)::BIGINT AS dedup_count, b1, b2, b3
  FROM truth GROUP BY ALL)"""
)

BLOCKS = f"""
blocks AS (
  SELECT DISTINCT 'L0' || (l_suppkey % 3) AS library_id, 1 AS cycle, (l_partkey % 8)::INT AS id, {tag("l_partkey % 8 + 16")} AS tag FROM lineitem
  UNION ALL
  SELECT DISTINCT 'L0' || (l_suppkey % 3), 2, (l_suppkey % 4)::INT, {tag("l_suppkey % 4 + 64")} FROM lineitem
  UNION ALL
  SELECT DISTINCT 'L0' || (l_suppkey % 3), 3, l_linenumber::INT, {tag("l_linenumber + 128")} FROM lineitem),
per_cycle AS (SELECT library_id, cycle, count(*)::DOUBLE AS n FROM blocks GROUP BY ALL)"""

SCORES = f"""{COUNTS}, {BLOCKS},
div AS (SELECT library_id, product(n) AS diversity FROM per_cycle GROUP BY ALL),
tot AS (SELECT selection_id, library_id, sum(count)::BIGINT AS total FROM counts GROUP BY ALL),
scores AS (
  SELECT selection_id, library_id, bb_ids, count, total, diversity,
    (count / total) / (1.0 / diversity) AS fold,
    (count / total - 1.0 / diversity) / sqrt((1.0 / diversity) * (1 - 1.0 / diversity)) AS z_n,
    (count + 1.96 * 1.96 / 2) / (total + 1.96 * 1.96) AS pt, total + 1.96 * 1.96 AS nt,
    1.0 / diversity AS p0
  FROM counts JOIN tot USING (selection_id, library_id) JOIN div USING (library_id))"""

SYNTHONS = """
synthons AS (
  SELECT selection_id, library_id, concat_ws(',', CASE WHEN g1 THEN '1' END, CASE WHEN g2 THEN '2' END, CASE WHEN g3 THEN '3' END) AS cycles,
    concat_ws(',', b1, b2, b3) AS synthon, n_compounds, count, raw_count, dedup_count
  FROM (SELECT selection_id, library_id, b1, b2, b3, grouping(b1) = 0 AS g1, grouping(b2) = 0 AS g2, grouping(b3) = 0 AS g3,
      count(*)::BIGINT AS n_compounds, sum(count)::BIGINT AS count, sum(raw_count)::BIGINT AS raw_count,
      sum(dedup_count)::BIGINT AS dedup_count
    FROM counts GROUP BY GROUPING SETS ((selection_id, library_id, b1), (selection_id, library_id, b2),
      (selection_id, library_id, b3), (selection_id, library_id, b1, b2), (selection_id, library_id, b1, b3),
      (selection_id, library_id, b2, b3), (selection_id, library_id, b1, b2, b3))))"""

VENDOR = f"""
items AS (
  SELECT DISTINCT l_suppkey AS s, (l_linenumber % 3 + 1)::INT AS cycle, (l_partkey % 50 + 1)::INT AS id FROM lineitem),
vrows AS (
  SELECT s, 'L' || s AS library_id, 'vendor_batch_L' || s || '.tsv' AS file, cycle, id,
    cycle * 1000 + id + CASE WHEN s % 10 = 5 AND cycle = 1 AND id > 25 THEN 10000 ELSE 0 END AS place,
    CASE WHEN s % 10 = 7 AND cycle = 2 THEN id + 1 ELSE id END AS r,
    CASE WHEN s % 10 = 8 AND cycle = 1 THEN NULL ELSE id END AS h,
    CASE WHEN (id + s) % 17 = 0 THEN NULL ELSE {dna("id*41+cycle*7", 11)} END AS tag,
    {dna("s*5+3", 12)} AS library_tag
  FROM items WHERE NOT (s % 10 = 3 AND cycle = 1) AND NOT (s % 10 = 4 AND cycle = 2) AND NOT (s % 10 = 6 AND cycle = 3)),
stepped AS (SELECT *, cycle - lag(cycle) OVER (PARTITION BY s ORDER BY place) AS step FROM vrows),
facts AS (
  SELECT file, library_id, library_tag, arg_min(cycle, place) AS first, coalesce(bool_and(step IN (0, 1)), true) AS steps,
    max(cycle) AS last, bool_and(coalesce(r = h, false)) AS same, count(*) FILTER (tag IS NULL)::BIGINT AS null_tags
  FROM stepped GROUP BY ALL),
verdicts AS (
  SELECT file, library_id, library_tag, CASE WHEN first <> 1 THEN 'first_cycle' WHEN NOT steps THEN 'cycle_step'
    WHEN last <> 3 THEN 'max_cycle' WHEN NOT same THEN 'index_mismatch' ELSE 'ok' END AS verdict, null_tags FROM facts)"""


def layout_sql(source: str) -> str:
    """Sections and running offsets over source(library_id, library_tag)."""
    ec = f"'{d.ERROR_CORRECTION}'"
    n = "'NNNNNNNNNNNN'"
    rows = [("primer1", "primer", f"'{d.PRIMER1}'", "''", "NULL")]
    rows += [(f"bb{i}", "bb", n, f"'{o}'", ec) for i, o in enumerate(d.OVERHANGS, start=1)]
    rows += [("library", "library", "library_tag", "NULL", "NULL"), ("umi", "umi", n, "NULL", "NULL")]
    rows += [("primer2", "primer", f"'{d.PRIMER2}'", "NULL", "NULL")]
    union = " UNION ALL ".join(
        f"SELECT library_id, {k}::INT AS ord, '{s}' AS section, '{kind}' AS kind, {t} AS tag,"
        f" {o}::VARCHAR AS overhang, {c}::VARCHAR AS error_correction FROM {source}"
        for k, (s, kind, t, o, c) in enumerate(rows)
    )
    return f"""SELECT *, coalesce(sum(length(tag) + coalesce(length(overhang), 0)) OVER (PARTITION BY library_id
      ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS start, length(tag)::INT AS len FROM ({union})"""


JOBS = """
ev AS (
  SELECT event_id, 'run_' || (user_id // 10) || '.log' AS run_id, event_id::VARCHAR AS job_id, event_id % 20 AS k, event_type,
    epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + floor(value * 1000)::BIGINT AS x FROM events WHERE event_id % 20 <> 19),
raw AS (
  SELECT run_id, job_id, event_id, k,
    CASE WHEN k=7 THEN 'RETRY:Again (2)' WHEN event_type='view' THEN 'DECODE:DecodeChunk (' || event_id || ')'
      WHEN event_type='click' THEN 'PREPROCESS:CONCAT (1)' WHEN event_type='error' THEN 'CountChunk (' || event_id || ')'
      WHEN event_type='purchase' THEN 'MergeStats' ELSE 'DECODE:Report (merged)' END AS process,
    CASE WHEN k=7 THEN 'Again' WHEN event_type='view' THEN 'DecodeChunk' WHEN event_type='click' THEN 'CONCAT'
      WHEN event_type='error' THEN 'CountChunk' WHEN event_type='purchase' THEN 'MergeStats' ELSE 'Report' END AS short,
    CASE WHEN k=3 THEN NULL WHEN k IN (8, 9) THEN 'FAILED' ELSE 'COMPLETED' END AS status,
    CASE k WHEN 3 THEN NULL WHEN 8 THEN '1' WHEN 9 THEN '2' ELSE '0' END AS exit_code,
    CASE WHEN k IN (3, 4) THEN NULL ELSE s END AS started_ms,
    CASE k WHEN 3 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN s - 300000 WHEN 9 THEN x + 60000 ELSE x END AS exited_ms
  FROM ev),
jobs AS (
  SELECT *, CASE WHEN exited_ms >= started_ms THEN printf('%.2f', (exited_ms - started_ms) / 60000::DOUBLE)::DOUBLE END AS duration_min FROM raw)"""

USAGE = """
seconds AS (SELECT event_id, floor(value * 10)::BIGINT AS sec FROM events),
usage AS (
  SELECT event_id::VARCHAR AS job_id,
    CASE WHEN event_id % 11 = 0 THEN '1-' ELSE '' END || lpad((sec // 3600)::VARCHAR, 2, '0') || ':' || lpad((sec // 60 % 60)::VARCHAR, 2, '0')
      || ':' || lpad((sec % 60)::VARCHAR, 2, '0') AS wall_clock,
    (event_id % 100) || '.25%' AS cpu_eff, (event_id % 1000 + 1) || '.50 ' || ['GB', 'MB', 'KB', 'TB'][event_id % 4 + 1] AS mem_used,
    (event_id % 90) || '.5%' AS mem_eff, '5.00 GB' AS mem_requested, '2' AS alloc_cpus,
    CASE WHEN event_id % 11 <> 0 THEN sec / 60.0 END AS wall, event_id % 100 + 0.25 AS cpu,
    (event_id % 1000 + 1.5)::DOUBLE * [1.0, 1/1024.0, 1/1024.0/1024.0, 1024.0][event_id % 4 + 1] AS gb, event_id % 90 + 0.5 AS eff
  FROM seconds)"""


def mean_sem(value: str, name: str) -> str:
    return (
        f"round(avg({value}), 6) AS avg_{name}, "
        f"round(stddev_samp({value}) / sqrt(count({value})), 6) AS sem_{name}"
    )


SEARCH = f"""
WITH {TRUTH}, {BLOCKS},
moved AS (
  SELECT selection_id, read_id, CASE WHEN rc=1 THEN {rc("m")} ELSE m END AS seq FROM (
    SELECT *, substr('TACTACTACTACT', 1, l_partkey % 13) || fwd AS m FROM truth)),
strands AS (
  SELECT DISTINCT seq, '+' AS strand, seq AS s FROM moved UNION ALL SELECT DISTINCT seq, '-', {rc("seq")} FROM moved),
libs AS (SELECT DISTINCT 'L0' || (l_suppkey % 3) AS library_id, {tag("l_suppkey % 3 * 41 + 27")} AS tl FROM lineitem),
placed AS (
  SELECT seq, strand, s, library_id, tl, p, greatest(p, 0) AS a, least(p + 12, length(s)) AS b
  FROM strands, libs, range(-4, 110) r(p) WHERE p <= length(s) - 8),
measured AS (
  SELECT seq, strand, s, library_id, p, b - a AS overlap,
    hamming(substr(s, a + 1, b - a), substr(tl, a - p + 1, b - a)) AS mm FROM placed),
per_library AS (
  SELECT seq, strand, any_value(s) AS s, library_id, min({{'mm': mm, 'ov': -overlap, 'p': p}}) AS k
  FROM measured WHERE mm <= 2 GROUP BY seq, strand, library_id),
per_strand AS (
  SELECT seq, strand, any_value(s) AS s, min(k) AS k, list({{'mm': k.mm, 'ov': k.ov, 'lib': library_id}}) AS cand FROM per_library GROUP BY seq, strand),
chosen AS (
  SELECT seq, arg_min({{'strand': strand, 's': s, 'k': k, 'cand': cand}}, k.mm * 2 + CASE strand WHEN '+' THEN 0 ELSE 1 END) AS c FROM per_strand GROUP BY seq),
called AS (
  SELECT seq, c.strand AS strand, c.s AS s, c.k.mm AS mm, c.k.p AS p,
    [x.lib FOR x IN c.cand IF x.mm = c.k.mm AND x.ov = c.k.ov] AS libs FROM chosen),
libcall AS (SELECT seq, strand, s, mm, p, CASE WHEN len(libs) = 1 THEN libs[1] END AS lib FROM called),
shifts AS (SELECT * FROM (VALUES (0, 0), (1, -1), (2, 1)) v(o, sh)),
windows AS (
  SELECT seq, lib, cycle, o, p + (cycle - 4) * 14 + sh AS w, s FROM libcall, shifts, range(1, 4) g(cycle) WHERE lib IS NOT NULL),
hits AS (
  SELECT w.seq, w.cycle, w.o, b.id, hamming(substr(w.s, w.w + 1, 12), b.tag) AS h
  FROM windows w JOIN blocks b ON b.library_id = w.lib AND b.cycle = w.cycle WHERE w.w >= 0 AND length(substr(w.s, w.w + 1, 12)) = 12),
near AS (SELECT seq, cycle, o, min(h) AS h FROM hits WHERE h <= 1 GROUP BY ALL),
resolved AS (
  SELECT n.seq, n.cycle, n.o, count(DISTINCT h.id) AS k, min(h.id) AS id FROM near n JOIN hits h USING (seq, cycle, o, h) GROUP BY ALL),
bbcall AS (
  SELECT seq, cycle, arg_min(id, o) FILTER (k = 1) AS id, bool_or(k > 1) AS amb FROM resolved GROUP BY ALL),
wide AS (
  SELECT seq, max(id) FILTER (cycle=1) AS i1, max(id) FILTER (cycle=2) AS i2, max(id) FILTER (cycle=3) AS i3,
    coalesce(bool_or(amb) FILTER (cycle=1), false) AS a1, coalesce(bool_or(amb) FILTER (cycle=2), false) AS a2,
    coalesce(bool_or(amb) FILTER (cycle=3), false) AS a3 FROM bbcall GROUP BY seq),
umis AS (SELECT *, CASE WHEN p + 12 >= 0 THEN substr(s, p + 13, 12) END AS umi FROM libcall),
final AS (
  SELECT m.selection_id, m.read_id, coalesce(u.strand, '+') AS strand, u.lib AS library_id, u.mm::INT AS lib_mismatches, u.umi,
    i1 || ',' || i2 || ',' || i3 AS bb_ids,
    CASE WHEN u.seq IS NULL THEN 'no_library' WHEN u.lib IS NULL THEN 'ambiguous_library'
      WHEN i1 IS NULL AND a1 THEN 'bb1_ambiguous' WHEN i1 IS NULL THEN 'bb1_unmatched'
      WHEN i2 IS NULL AND a2 THEN 'bb2_ambiguous' WHEN i2 IS NULL THEN 'bb2_unmatched'
      WHEN i3 IS NULL AND a3 THEN 'bb3_ambiguous' WHEN i3 IS NULL THEN 'bb3_unmatched'
      WHEN u.umi IS NULL OR length(u.umi) < 12 THEN 'umi_invalid' ELSE 'ok' END AS outcome
  FROM moved m LEFT JOIN umis u USING (seq) LEFT JOIN wide USING (seq))
SELECT selection_id, read_id, strand, library_id, CASE WHEN outcome='ok' THEN bb_ids END AS bb_ids,
  CASE WHEN outcome='ok' THEN umi END AS umi, lib_mismatches, outcome FROM final"""

# What each selection's libraries, strands, shifts and tolerance let through.
MANY_SELECTIONS = f"""
WITH {TRUTH},
asked AS (
  SELECT *, l_partkey % 72 AS k, (k // 4) % 3 AS strands, (k // 12) % 2 = 0 AS wiggle, CASE k % 4 WHEN 2 THEN 2 ELSE k // 36 END AS tolerance,
    CASE k % 4 WHEN 0 THEN [0] WHEN 1 THEN [1, 2] WHEN 2 THEN [0, 1, 2] ELSE [2] END AS own FROM truth),
near AS (
  SELECT *, CASE WHEN k < 70 AND (strands = 0 OR strands = 2 - rc) AND (e <> 7 OR wiggle) AND e <> 11
    THEN list_filter([{{'mm': hamming(tl, {tag("x*41+27")}), 'x': x}} FOR x IN own], lambda c: c.mm <= tolerance) ELSE [] END AS cand FROM asked),
called AS (
  SELECT *, list_min(cand) AS best, len(list_filter(cand, lambda c: c.mm = list_min(cand).mm)) AS n FROM near),
ended AS (
  SELECT *, CASE WHEN k >= 70 THEN 'unknown_selection' WHEN n = 0 THEN 'no_library' WHEN n > 1 THEN 'ambiguous_library'
    WHEN e = 13 THEN 'bb3_unmatched' WHEN e = 15 THEN 'umi_invalid' ELSE 'ok' END AS o FROM called)
SELECT 's' || k AS selection_id, read_id, CASE WHEN k >= 70 THEN NULL WHEN n > 0 THEN CASE rc WHEN 1 THEN '-' ELSE '+' END WHEN strands = 1 THEN '-' ELSE '+' END AS strand,
  CASE WHEN n = 1 THEN 'L0' || best.x END AS library_id, CASE WHEN o = 'ok' THEN bb_ids END AS bb_ids, CASE WHEN o = 'ok' THEN umi END AS umi,
  best.mm::INT AS lib_mismatches, o AS outcome
FROM ended
"""



def _section_steps() -> str:
    """Cycles from the library tag outwards: each begins where the one before it left off."""
    out = ""
    for c in (3, 2, 1):
        start, nearer = ("0", "") if c == 3 else (f"done{c + 1}.moved", f"JOIN done{c + 1} USING (seq)")
        end = f"pos + ({c} - 4) * 14 + 12 + c0 + sh"
        out += f"""
moved{c} AS (SELECT d.seq, d.s, d.pos, d.lib, d.id{c}, d.amb{c}, d.sh{c}, {start} AS c0 FROM first d {nearer}),
tried{c} AS (
  SELECT seq, o, sh, c0, n, b.id, levenshtein(substr(s, {end} - n + 1, n), tag) AS lev
  FROM moved{c} m, shifts, range(11, 14) l(n), blocks b
  WHERE id{c} IS NULL AND b.library_id = lib AND b.cycle = {c} AND {end} - n >= 0 AND {end} <= length(s)),
best{c} AS (
  SELECT seq, o, min(c0 + sh) AS put, min(lev) AS low, list({{'id': id, 'lev': lev, 'r': 2 * abs(n - 12) + (n > 12)::INT, 'n': n}}) AS f
  FROM tried{c} WHERE lev <= 1 GROUP BY seq, o),
ids{c} AS (SELECT *, list_distinct([x.id FOR x IN f IF x.lev = low]) AS ids, list_min([{{'r': x.r, 'n': x.n}} FOR x IN f IF x.lev = low]).n AS n FROM best{c}),
called{c} AS (SELECT seq, arg_min({{'id': ids[1], 'moved': put - (n - 12)}}, o) FILTER (len(ids) = 1) AS got, bool_or(len(ids) > 1) AS amb FROM ids{c} GROUP BY seq),
done{c} AS (
  SELECT m.seq, coalesce(m.id{c}, k.got.id) AS id, m.amb{c} OR coalesce(k.amb, false) AS amb,
    CASE WHEN m.id{c} IS NOT NULL THEN m.sh{c} ELSE coalesce(k.got.moved, m.c0) END AS moved FROM moved{c} m LEFT JOIN called{c} k USING (seq)),"""
    return out


# The library tag is where it was moved to; windows of 11 to 13 bases for the sections that no window of 12 settles.
INDEL_SECTIONS = f"""
WITH {NO_ERRORS}, {BLOCKS},
indels AS (
  SELECT *, l_orderkey % 7 AS w, CASE w WHEN 1 THEN substr(fwd, 1, 30) || substr(fwd, 32) WHEN 2 THEN substr(fwd, 1, 45) || 'A' || substr(fwd, 46)
    WHEN 3 THEN substr(fwd, 1, 16) || substr(fwd, 18, 28) || 'A' || substr(fwd, 46) WHEN 4 THEN substr(fwd, 1, 30) || substr(fwd, 32, 14) || substr(fwd, 47)
    WHEN 5 THEN substr(fwd, 1, 16) || substr(fwd, 18, 13) || substr(fwd, 32, 14) || substr(fwd, 47) ELSE fwd END AS f,
    53 + CASE w WHEN 1 THEN -1 WHEN 2 THEN 1 WHEN 4 THEN -2 WHEN 5 THEN -3 ELSE 0 END
      -- The tag of library 1 repeats AC: before such a UMI it is found where the layout puts it, two bases late.
      + CASE WHEN lib = 1 AND w IN (4, 5) AND umi LIKE 'AC%' THEN 2 ELSE 0 END AS true_pos,
    -- The tag of library 0 is its own reverse complement: where it is searched for, the forward strand wins.
    rc = 1 AND lib = 0 AND w IN (4, 5) AS turned FROM truth),
changed AS (
  SELECT *, CASE WHEN turned OR rc = 0 THEN '+' ELSE '-' END AS strand FROM (
    SELECT *, CASE WHEN turned THEN {rc("f")} ELSE f END AS s, CASE WHEN turned THEN length(f) - true_pos - 12 ELSE true_pos END AS pos FROM indels)),
distinct_reads AS (SELECT DISTINCT s AS seq, s, pos, library_id AS lib FROM changed),
shifts AS (SELECT * FROM (VALUES (0, 0), (1, -1), (2, 1)) v(o, sh)),
plain AS (
  SELECT seq, b.cycle, o, sh, b.id, CASE WHEN pos + (b.cycle - 4) * 14 + sh + 12 <= length(s) THEN hamming(rpad(substr(s, pos + (b.cycle - 4) * 14 + sh + 1, 12), 12, '-'), b.tag) END AS h
  FROM distinct_reads, shifts, blocks b WHERE b.library_id = lib AND pos + (b.cycle - 4) * 14 + sh >= 0),
plain_low AS (SELECT seq, cycle, o, any_value(sh) AS sh, min(h) AS low, list({{'id': id, 'h': h}}) AS f FROM plain WHERE h <= 1 GROUP BY seq, cycle, o),
plain_ids AS (SELECT *, list_distinct([x.id FOR x IN f IF x.h = low]) AS ids FROM plain_low),
plain_call AS (SELECT seq, cycle, arg_min({{'id': ids[1], 'sh': sh}}, o) FILTER (len(ids) = 1) AS k, bool_or(len(ids) > 1) AS amb FROM plain_ids GROUP BY seq, cycle),
first AS (
  SELECT r.*, {", ".join(f"c{i}.k.id AS id{i}, c{i}.k.sh AS sh{i}, coalesce(c{i}.amb, false) AS amb{i}" for i in (1, 2, 3))}
  FROM distinct_reads r {" ".join(f"LEFT JOIN plain_call c{i} ON c{i}.seq = r.seq AND c{i}.cycle = {i}" for i in (1, 2, 3))}),
{_section_steps()}
ended AS (
  SELECT m.*, d1.id AS i1, d2.id AS i2, d3.id AS i3, substr(m.s, m.pos + 13, 12) AS umi_,
    CASE WHEN d1.id IS NULL AND d1.amb THEN 'bb1_ambiguous' WHEN d1.id IS NULL THEN 'bb1_unmatched'
      WHEN d2.id IS NULL AND d2.amb THEN 'bb2_ambiguous' WHEN d2.id IS NULL THEN 'bb2_unmatched'
      WHEN d3.id IS NULL AND d3.amb THEN 'bb3_ambiguous' WHEN d3.id IS NULL THEN 'bb3_unmatched' ELSE 'ok' END AS o
  FROM changed m JOIN done1 d1 ON d1.seq = m.s JOIN done2 d2 ON d2.seq = m.s JOIN done3 d3 ON d3.seq = m.s)
SELECT selection_id, read_id, strand, library_id, CASE WHEN o = 'ok' THEN i1 || ',' || i2 || ',' || i3 END AS bb_ids,
  CASE WHEN o = 'ok' THEN umi_ END AS umi, 0::INT AS lib_mismatches, o AS outcome
FROM ended
"""

# Every stretch of every read against every tag; tags end at the least (distance, end, library).
SEARCH_INDELS = f"""
WITH {TRUTH},
moved AS (
  SELECT selection_id, read_id, CASE WHEN rc=1 THEN {rc("m")} ELSE m END AS seq FROM (
    SELECT *, substr('TACTACTACTACT', 1, l_partkey % 13) || CASE b3 % 3 WHEN 1 THEN substr(fwd, 1, 57) || substr(fwd, 59)
      WHEN 2 THEN substr(fwd, 1, 58) || 'A' || substr(fwd, 59) ELSE fwd END AS m FROM truth)),
strands AS (
  SELECT DISTINCT seq, '+' AS strand, seq AS s FROM moved UNION ALL SELECT DISTINCT seq, '-', {rc("seq")} FROM moved),
libs AS (SELECT DISTINCT 'L0' || (l_suppkey % 3) AS library_id, {tag("l_suppkey % 3 * 41 + 27")} AS tl FROM lineitem),
stretches AS (
  SELECT seq, strand, library_id, levenshtein(substr(s, p + 1, n), tl) AS lev, p, n
  FROM strands, libs, range(0, 110) r(p), range(10, 15) l(n) WHERE p + n <= length(s)),
near AS (
  SELECT seq, strand, min({{'lev': lev, 'e': p + n, 'lib': library_id, 'r': 2 * abs(n - 12) + (n > 12)::INT, 'p': p}}) AS k,
    list({{'lev': lev, 'lib': library_id}}) AS cand FROM stretches WHERE lev <= 2 GROUP BY ALL),
chosen AS (
  SELECT seq, arg_min({{'strand': strand, 'k': k, 'n': len(list_distinct([x.lib FOR x IN cand IF x.lev = k.lev]))}}, k.lev * 2 + (strand = '-')::INT) AS c
  FROM near GROUP BY seq)
SELECT selection_id, read_id, coalesce(c.strand, '+') AS strand, CASE WHEN c.n = 1 THEN c.k.lib WHEN c.n > 1 THEN '*' END AS library_id,
  c.k.p::INT AS lib_pos, c.k.e::INT AS lib_end, (c.k.e - c.k.p - 12)::INT AS lib_surplus, c.k.lev::INT AS lib_mismatches
FROM moved LEFT JOIN chosen USING (seq)
"""


ORACLE_SQL = {
    "decode_reads": f"WITH {DECODED} SELECT * FROM decoded",
    "decode_outcomes": f"WITH {TRUTH} SELECT selection_id, outcome, count(*)::BIGINT AS n FROM truth GROUP BY ALL",
    "decode_fallback": SEARCH,
    "search_indels": SEARCH_INDELS,
    "indel_sections": INDEL_SECTIONS,
    "decode_selections": MANY_SELECTIONS,
    "fastq_roundtrip": f"WITH {TRUTH} SELECT read_id, seq, repeat('I', length(seq)) AS qual FROM truth",
    "fastq_lanes_gz": f"""WITH {TRUTH} SELECT (l_orderkey % 3)::INT AS lane, (row_number() OVER (PARTITION BY l_orderkey % 3
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)::BIGINT AS ordinal, read_id, seq FROM truth""",
    "pair_merge": f"""WITH {TRUTH} SELECT selection_id, read_id, fwd AS seq, repeat('I', length(fwd)) AS qual,
        64::INT AS len_r1, 64::INT AS len_r2, CASE WHEN e IN (6, 8) THEN 1 ELSE 0 END::INT AS n_corrected FROM truth""",
    "paired_lanes": f"""WITH {TRUTH} SELECT (l_orderkey % 3)::INT AS lane, (row_number() OVER (PARTITION BY l_orderkey % 3
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)::BIGINT AS ordinal, read_id, read_id AS read_id_r2, fwd AS seq,
        CASE WHEN e IN (6, 8) THEN 1 ELSE 0 END::INT AS n_corrected FROM truth""",
    "paired_scan": f"""WITH {TRUTH} SELECT (row_number() OVER (ORDER BY l_orderkey % 3,
        l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)::BIGINT AS ordinal, read_id, read_id AS read_id_r2, fwd AS seq,
        CASE WHEN e IN (6, 8) THEN 1 ELSE 0 END::INT AS n_corrected FROM truth""",
    "pairing_qc": """WITH n AS (SELECT row_number() OVER (PARTITION BY l_orderkey % 3) - 1 AS o FROM lineitem)
        SELECT 'run' AS selection_id, count(*)::BIGINT AS n_r1, count(*) FILTER (o % 10 <> 3)::BIGINT AS n_r2,
        count(*) FILTER (o % 10 <> 3)::BIGINT AS n_pairs, 0::BIGINT AS n_id_mismatch FROM n""",
    "correction_qc": f"""WITH {TRUTH} SELECT selection_id, count(*)::BIGINT AS n_merged, count(*) FILTER (e IN (6, 8))::BIGINT AS n_corrected,
        count(*) FILTER (e IN (6, 8))::BIGINT AS n_reads_corrected FROM truth GROUP BY ALL""",
    "read_filter": f"WITH {NOISY} SELECT selection_id, read_id, seq FROM kept",
    "read_qc": f"WITH {NOISY} {totals('scored', 'before')} UNION ALL {totals('kept', 'after')}",
    "cycle_qc": f"""WITH {NOISY} SELECT selection_id, i::INT AS pos, substr(seq, i::INT + 1, 1) AS base, count(*)::BIGINT AS n,
        round(avg(q[i + 1]), 6) AS mean_quality FROM scored, range(0, 90) r(i) WHERE i < length(seq) GROUP BY ALL""",
    "length_histogram": f"WITH {NOISY} SELECT selection_id, length(seq)::INT AS length, count(*)::BIGINT AS n FROM noisy GROUP BY ALL",
    "selection_files": """SELECT coalesce(CASE WHEN c_custkey % 7 <> 0 THEN 's' || c_custkey END, 'unknown') AS selection_id,
        lane::INT AS lane, 'lane' || (lane + 1) || '_' || c_custkey || '.fastq.gz' AS path FROM customer, range(0, 3) r(lane)
        WHERE NOT (lane = 1 AND c_custkey % 3 = 0) AND NOT (lane = 2 AND c_custkey % 4 = 0)""",
    "output_prefixes": """SELECT c_name AS additional_info, CASE WHEN c_custkey % 5 = 0 THEN 'p' || c_custkey
        WHEN c_custkey % 7 <> 0 THEN 's' || c_custkey ELSE 'unknown' END AS file_prefix FROM customer""",
    "library_layout": f"""WITH libs AS (SELECT 'L' || s_suppkey AS library_id, substr({dna("s_suppkey*7+3", 14)}, 1, s_suppkey % 4 + 10) AS library_tag
        FROM supplier) {layout_sql("libs")}""",
    "collect_umis": f"WITH {TALLY} SELECT * FROM tally",
    "count_compounds": f"{CLUSTERS} SELECT * FROM clustered",
    "tally_counts": f"""WITH {TALLY} SELECT selection_id, library_id, bb_ids, count(*)::BIGINT AS n_umis, sum(c)::BIGINT AS raw_count,
        count(*)::BIGINT AS dedup_count FROM tally GROUP BY ALL""",
    "decode_stats": f"""WITH {DECODED} SELECT selection_id, 'library' AS level, library_id, outcome, count(*)::BIGINT AS n FROM decoded GROUP BY ALL
        UNION ALL SELECT selection_id, 'total', NULL, outcome, count(*)::BIGINT FROM decoded GROUP BY ALL""",
    "decode_summary": f"""{CLUSTERS},
      outs AS (SELECT selection_id, library_id, {PIVOT}, count(*)::BIGINT AS reads FROM decoded GROUP BY ALL),
      sums AS (SELECT selection_id, library_id, count(*)::BIGINT AS compounds, sum(raw_count)::BIGINT AS raw_count,
        sum(dedup_count)::BIGINT AS dedup_count, sum(count)::BIGINT AS count FROM clustered GROUP BY ALL),
      both_sides AS (SELECT o.*, coalesce(compounds, 0) AS compounds, coalesce(raw_count, 0) AS raw_count,
        coalesce(dedup_count, 0) AS dedup_count, coalesce(count, 0) AS count FROM outs o LEFT JOIN sums USING (selection_id, library_id)),
      rolled AS (SELECT selection_id, 'library' AS level, library_id, compounds, raw_count, dedup_count, count, {", ".join(OUTCOMES)}, reads FROM both_sides
        UNION ALL SELECT selection_id, 'total', NULL, sum(compounds)::BIGINT, sum(raw_count)::BIGINT, sum(dedup_count)::BIGINT, sum(count)::BIGINT,
        {", ".join(f"sum({o})::BIGINT" for o in OUTCOMES)}, sum(reads)::BIGINT FROM both_sides GROUP BY selection_id)
      SELECT *, CASE WHEN dedup_count > 0 THEN round(raw_count / dedup_count, 6) END AS duplication_rate FROM rolled""",
    "report_outcomes": f"WITH {DECODED} SELECT selection_id, library_id, {PIVOT} FROM decoded GROUP BY ALL",
    "report_histogram": f"""WITH {COUNTS} SELECT selection_id, library_id, floor(log2(count))::INT AS log2_bin, count(*)::BIGINT AS compounds,
        sum(count)::BIGINT AS count FROM (SELECT selection_id, library_id, count FROM counts) GROUP BY selection_id, library_id, floor(log2(count))::INT""",
    "union_counts": f"""WITH {COUNTS} SELECT selection_id, library_id, bb_ids, count, raw_count, dedup_count FROM counts
        UNION ALL SELECT 'again', library_id, bb_ids, count, NULL, NULL FROM counts WHERE library_id = 'L01'""",
    "dedup_counts": f"""WITH {COUNTS} SELECT selection_id, library_id, bb_ids, count, raw_count, dedup_count FROM counts
        UNION ALL SELECT selection_id || '+', library_id, bb_ids, count * f, raw_count * f, dedup_count * f
        FROM (SELECT *, CASE WHEN count % 2 = 0 THEN 2 ELSE 1 END AS f FROM counts)""",
    "mixed_cycles": f"""WITH {COUNTS},
        own AS (SELECT selection_id, library_id, CASE library_id WHEN 'L00' THEN b1 || ',' || b2 WHEN 'L01' THEN bb_ids ELSE bb_ids || ',' || b1 END AS bb_ids,
          sum(count)::BIGINT AS count, sum(raw_count)::BIGINT AS raw_count, sum(dedup_count)::BIGINT AS dedup_count FROM counts GROUP BY ALL),
        masks AS (SELECT *, string_split(bb_ids, ',') AS bb, unnest(range(1, CASE library_id WHEN 'L00' THEN 4 WHEN 'L01' THEN 8 ELSE 16 END)) AS mask FROM own)
        SELECT selection_id, library_id, concat_ws(',', CASE WHEN mask & 1 > 0 THEN '1' END, CASE WHEN mask & 2 > 0 THEN '2' END,
          CASE WHEN mask & 4 > 0 THEN '3' END, CASE WHEN mask & 8 > 0 THEN '4' END) AS cycles,
          concat_ws(',', CASE WHEN mask & 1 > 0 THEN bb[1] END, CASE WHEN mask & 2 > 0 THEN bb[2] END, CASE WHEN mask & 4 > 0 THEN bb[3] END,
          CASE WHEN mask & 8 > 0 THEN bb[4] END) AS synthon, count(*)::BIGINT AS n_compounds, sum(count)::BIGINT AS count,
          sum(raw_count)::BIGINT AS raw_count, sum(dedup_count)::BIGINT AS dedup_count FROM masks GROUP BY ALL""",
    "run_counts": f"""WITH {SCORES},
        own AS (SELECT library_id, bb_ids, sum(count)::BIGINT AS count FROM counts GROUP BY ALL),
        own_total AS (SELECT library_id, sum(count)::BIGINT AS total FROM own GROUP BY ALL)
        SELECT NULL::VARCHAR AS selection_id, library_id, bb_ids, count, o.total, round((count / o.total) * diversity, 6) AS fold,
          round((count / o.total - 1.0 / diversity) / sqrt((1.0 / diversity) * (1 - 1.0 / diversity)), 6) AS z_n,
          (rank() OVER (PARTITION BY library_id ORDER BY count DESC))::BIGINT AS rank
        FROM own JOIN own_total o USING (library_id) JOIN div USING (library_id)""",
    "unlisted_selections": f"""WITH {DECODED} SELECT selection_id, count(*) FILTER (selection_id = 'tgt' AND outcome = 'ok')::BIGINT AS ok,
        count(*) FILTER (selection_id <> 'tgt')::BIGINT AS unknown_selection, count(*)::BIGINT AS reads FROM decoded GROUP BY ALL""",
    "synthon_counts": f"WITH {COUNTS}, {SYNTHONS} SELECT * FROM synthons",
    "enrichment": f"""WITH {SCORES} SELECT selection_id, library_id, bb_ids, count, total, diversity, round(fold, 6) AS fold, round(z_n, 6) AS z_n,
        round((pt - 1.96 * sqrt(pt * (1 - pt) / nt) - p0) / sqrt(p0 * (1 - p0)), 6) AS z_low,
        round((pt + 1.96 * sqrt(pt * (1 - pt) / nt) - p0) / sqrt(p0 * (1 - p0)), 6) AS z_high FROM scores""",
    "synthon_enrichment": f"""WITH {SCORES}, {SYNTHONS},
        sdiv AS (SELECT cycles, library_id, product(n) AS diversity FROM (SELECT DISTINCT cycles FROM synthons) c
          JOIN per_cycle p ON list_contains(string_split(c.cycles, ','), p.cycle::VARCHAR) GROUP BY ALL)
        SELECT s.selection_id, s.library_id, s.cycles, s.synthon, s.count, v.diversity, round((s.count / total) * v.diversity, 6) AS fold,
          round((s.count / total - 1.0 / v.diversity) / sqrt((1.0 / v.diversity) * (1 - 1.0 / v.diversity)), 6) AS z_n
        FROM synthons s JOIN sdiv v USING (cycles, library_id) JOIN tot t ON t.selection_id = s.selection_id AND t.library_id = s.library_id""",
    "enrichment_contrast": f"""WITH {COUNTS},
        t AS (SELECT library_id, sum(count) FILTER (selection_id='tgt')::BIGINT AS n_target, sum(count) FILTER (selection_id='ctrl')::BIGINT AS n_control FROM counts GROUP BY ALL),
        k AS (SELECT library_id, bb_ids, coalesce(sum(count) FILTER (selection_id='tgt'), 0)::BIGINT AS k_target,
          coalesce(sum(count) FILTER (selection_id='ctrl'), 0)::BIGINT AS k_control FROM counts GROUP BY ALL)
        SELECT library_id, bb_ids, k_target, k_control, n_target, n_control,
          round(((k_target + 1.0) / (n_target + 1.0)) / ((k_control + 1.0) / (n_control + 1.0)), 6) AS ratio FROM k JOIN t USING (library_id)""",
    "enrichment_rank": f"""WITH {SCORES} SELECT selection_id, library_id, bb_ids, (rank() OVER w)::BIGINT AS rank, round(percent_rank() OVER w, 6) AS percent_rank
        FROM scores WINDOW w AS (PARTITION BY selection_id, library_id ORDER BY count DESC)""",
    "top_enriched": f"""WITH {SCORES} SELECT * FROM (SELECT selection_id, library_id, bb_ids, count, (row_number() OVER (PARTITION BY selection_id, library_id
        ORDER BY count DESC, bb_ids))::INT AS place FROM scores) WHERE place <= 10""",
    "top_enriched_many": f"""WITH {TRUTH}, rows AS (SELECT selection_id, library_id, read_id AS bb_ids,
        CASE WHEN l_orderkey % 11 <> 0 THEN ((l_partkey * 7 + l_orderkey) % 500) / 4 END::DOUBLE AS z_n FROM truth)
        SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY selection_id, library_id ORDER BY z_n DESC NULLS LAST, bb_ids))::INT AS place FROM rows)
        WHERE place <= 5000""",
    "top_enriched_overall": f"""WITH {SCORES} SELECT selection_id, library_id, bb_ids, count FROM scores
        ORDER BY z_n DESC, bb_ids, selection_id, library_id LIMIT 25""",
    "attach_building_blocks": f"WITH {COUNTS} SELECT selection_id, library_id, bb_ids, {tag('b1+16')} AS tag1, {tag('b2+64')} AS tag2, {tag('b3+128')} AS tag3 FROM counts",
    "unused_building_blocks": f"""WITH {BLOCKS}, defined AS (SELECT DISTINCT 'L0' || (p_partkey % 3) AS library_id, (p_partkey % 2 + 1)::INT AS cycle,
        (p_partkey // 6 + 2)::INT AS id FROM part)
        SELECT library_id, cycle, id, 'unused' AS what FROM (SELECT * FROM defined EXCEPT SELECT library_id, cycle, id FROM blocks)
        UNION ALL SELECT library_id, cycle, id, 'unknown' FROM (SELECT library_id, cycle, id FROM blocks EXCEPT SELECT * FROM defined)""",
    "library_diversity": f"""WITH {BLOCKS} SELECT library_id, product(n) AS diversity, 'all' AS cycles FROM per_cycle GROUP BY ALL
        UNION ALL SELECT library_id, product(n), '1,3' FROM per_cycle WHERE cycle IN (1, 3) GROUP BY ALL""",
    "vendor_validate": f"WITH {VENDOR} SELECT file, library_id, library_tag, verdict, null_tags FROM verdicts",
    "vendor_totals": f"""WITH {VENDOR} SELECT count(*) FILTER (verdict = 'ok')::BIGINT AS succeeded, count(*) FILTER (verdict <> 'ok')::BIGINT AS failed FROM verdicts""",
    "vendor_max_index": f"WITH {VENDOR} SELECT library_id, cycle, max(h)::DOUBLE AS max_index FROM vrows GROUP BY ALL",
    "vendor_null_tags": f"WITH {VENDOR} SELECT library_id, h::VARCHAR AS hits_index, cycle::DOUBLE AS cycle FROM vrows WHERE tag IS NULL",
    "vendor_convert": f"""WITH {VENDOR} SELECT library_id, cycle, library_id || '_BB' || chr(64 + cycle) AS bb_set_name, id, tag
        FROM vrows JOIN (SELECT library_id FROM verdicts WHERE verdict = 'ok') USING (library_id)""",
    "vendor_libraries": f"WITH {VENDOR}, good AS (SELECT library_id, library_tag FROM verdicts WHERE verdict = 'ok') {layout_sql('good')}",
    "vendor_sets": f"""WITH {VENDOR} SELECT library_id, i::INT AS cycle, library_id || '_BB' || chr(64 + i::INT) AS bb_set_name, library_id || '_BBA' AS dna_barcode_on
        FROM verdicts, range(1, 4) r(i) WHERE verdict = 'ok'""",
    "job_records": f"WITH {JOBS} SELECT run_id, job_id, process, status, exit_code, started_ms, exited_ms, duration_min FROM jobs",
    "job_summary": f"""WITH {JOBS} SELECT short AS process, count(*)::BIGINT AS n, {mean_sem('duration_min', 'dur_min')},
        CASE WHEN short = 'CONCAT' THEN '4' ELSE '1' END AS req_cpus, CASE WHEN short IN ('DecodeChunk', 'Report') THEN '8 GB' ELSE '4 GB' END AS req_memory,
        CASE WHEN short = 'CONCAT' THEN '3h' ELSE '1h' END AS req_time FROM jobs GROUP BY short""",
    "job_usage_summary": f"""WITH {JOBS}, {USAGE} SELECT short AS process, count(*)::BIGINT AS n, {mean_sem('wall', 'wall_min')}, {mean_sem('cpu', 'cpu_eff_pct')},
        {mean_sem('gb', 'mem_used_gb')}, {mean_sem('eff', 'mem_eff_pct')} FROM jobs LEFT JOIN usage USING (job_id) GROUP BY short""",
    "job_status": f"""WITH {JOBS} SELECT count(*)::BIGINT AS total, count(*) FILTER (status='COMPLETED')::BIGINT AS completed,
        count(*) FILTER (status='FAILED')::BIGINT AS failed, count(*) FILTER (status IS NULL)::BIGINT AS other FROM jobs""",
    "usage_records": f"WITH {USAGE} SELECT job_id, wall_clock, cpu_eff, mem_used, mem_eff, mem_requested, alloc_cpus FROM usage",
    "incremental_counts": f"{CLUSTERS} SELECT * FROM clustered",
    "sequence_functions": f"""WITH {TRUTH} SELECT read_id, {rc('seq')} AS rc, hamming(substr(fwd, 1, 24), substr(fwd, 2, 24))::INT AS mismatches,
        levenshtein(substr(fwd, 1, 24), substr(fwd, 2, 24)) <= 2 AS near, substr(seq, 11, 12) AS section, (ascii(substr(seq, 3, 1)) - 33)::INT AS q,
        repeat('N', b1) AS mask, library_id || '_BB' || chr(65 + b2) AS set_name, b3 || ',' || b1 AS bb_ids, b2 AS distance FROM truth""",
    "text_functions": """SELECT event_id, (event_id % 5 * 60 + 10 + (event_id % 60) / 60.0)::DOUBLE AS wall, (event_id % 100 + 0.5)::DOUBLE AS pct,
        ((event_id % 2048) / CASE WHEN event_id % 2 = 0 THEN 1024 ELSE 1048576 END)::DOUBLE AS gb, event_type AS name,
        'B' || (event_id % 7) AS status, event_id::VARCHAR AS job_id, 'L' || event_id AS lib, printf('%.3f', value) AS shown FROM events""",
}

# Tables written and read back hold what they held before.
ORACLE_SQL |= {
    "decoded_tsv": ORACLE_SQL["decode_reads"],
    "counts_parquet": ORACLE_SQL["count_compounds"],
    "written_tables": ORACLE_SQL["enrichment"],
    "collected_json": f"WITH {TALLY} SELECT library_id, bb_ids, umi, c FROM tally WHERE selection_id = 'tgt'",
    "stats_files": f"WITH {DECODED} SELECT selection_id || '_decode_stats.json' AS file, library_id, outcome, count(*)::BIGINT AS n FROM decoded GROUP BY ALL",
    "job_tables": f"""WITH {JOBS} SELECT job_id, process, coalesce(status, 'SUBMITTED') AS status, coalesce(exit_code, '-') AS exit,
        coalesce(strftime(make_timestamp(started_ms * 1000), '%Y-%m-%d %H:%M:%S'), '-') AS started,
        coalesce(strftime(make_timestamp(exited_ms * 1000), '%Y-%m-%d %H:%M:%S'), '-') AS exited, round(duration_min, 6) AS duration_min FROM jobs""",
    "job_summary_table": f"""WITH {JOBS}, {USAGE} SELECT short AS process, count(*)::VARCHAR AS n, printf('%.2f', avg(wall)) AS avg_wall_min,
        printf('%.2f', avg(cpu)) AS "avg_cpu_eff_%", printf('%.3f', avg(gb)) AS avg_mem_used_gb, printf('%.2f', avg(eff)) AS "avg_mem_eff_%"
        FROM jobs LEFT JOIN usage USING (job_id) GROUP BY short""",
    "ordered_reports": f"""WITH {JOBS}, numbered AS (
        SELECT run_id || ':' || job_id AS name, run_id, (row_number() OVER (PARTITION BY run_id ORDER BY job_id::BIGINT) - 1)::BIGINT AS place FROM jobs)
        SELECT 'file' AS what, path AS name, (row_number() OVER (ORDER BY path) - 1)::BIGINT AS place FROM (
          SELECT DISTINCT 'lane' || (lane + 1) || '_' || c_custkey || '.fastq.gz' AS path FROM customer, range(0, 3) r(lane)
          WHERE NOT (lane = 1 AND c_custkey % 3 = 0) AND NOT (lane = 2 AND c_custkey % 4 = 0))
        UNION ALL SELECT 'process', short, (row_number() OVER (ORDER BY short) - 1)::BIGINT FROM (SELECT DISTINCT short FROM jobs)
        UNION ALL SELECT 'job', name, place FROM numbered
        UNION ALL SELECT * FROM (SELECT 'first', name, 0::BIGINT FROM numbered WHERE place = 0 ORDER BY run_id LIMIT 1)""",
}
