"""The queries' equivalents in SQL (DuckDB), built from shared common table expressions."""

from __future__ import annotations

from ..functions import text as T
from .views import CAP, K, REL, SEEN

Q = lambda s: "'" + s.replace("'", "''") + "'"


def _map(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{Q(k)}: {Q(v)}" for k, v in pairs.items()) + "}"


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(map(Q, xs)) + "]"


def fold(x: str) -> str:
    return f"lower(replace(strip_accents({x}), 'ß', 'ss'))"


def blank(x: str) -> str:
    return f"regexp_replace({x}, {Q(T.BLANKS)}, ' ', 'g')"


def site(x: str) -> str:
    return f"regexp_replace({x}, {Q(T.SITE)}, ' \\1 ', 'g')"


def number(t: str) -> str:
    t = f"regexp_replace({t}, {Q(T.ORDINAL)}, '\\1')"
    return f"CASE WHEN regexp_full_match({t}, '\\d+') THEN coalesce(nullif(ltrim({t}, '0'), ''), '0') ELSE {t} END"


def skeleton(t: str) -> str:
    s = t
    for a, b in T.DIGRAPHS:
        s = f"replace({s}, {Q(a)}, {Q(b)})"
    s = f"replace({s}, 'x', 'ks')"
    s = f"regexp_replace(translate({s}, {Q(T.LETTERS_FROM[: len(T.LETTERS_TO)])}, {Q(T.LETTERS_TO)}), '[{T.LETTERS_FROM[len(T.LETTERS_TO) :]}]', '', 'g')"
    # Without back references: drop each character equal to the one before.
    chars = f"string_split({s}, '')"
    once = f"array_to_string(list_filter({chars}, lambda c, i: i = 1 OR c <> ({chars})[i - 1]), '')"
    return f"CASE WHEN regexp_full_match({t}, '\\d+') THEN '' ELSE {once} END"


def share(salt: int, *key: str) -> str:
    """:func:`tessera.operators.learn.share_of` with the default seed."""
    return f"(('0x' || substr(md5({salt} || '|' || {" || '|' || ".join(key)}), 1, 8))::BIGINT % 10000) / 10000.0::DOUBLE"


def name_words(x: str) -> str:
    s = site(f"replace({blank(fold(x))}, chr(38), ' and ')")
    s = f"regexp_replace({s}, '[.'']', '', 'g')"
    kept = f"list_filter(regexp_split_to_array({s}, '[^a-z0-9]+'), lambda t: t <> '' AND NOT regexp_full_match(t, '\\d{{7,}}'))"
    return f"list_transform({kept}, lambda t: coalesce(({_map(T.NAME_WORDS)})[t], {number('t')}))"


def addr_words(x: str) -> str:
    s = f"replace(replace({blank(fold(x))}, chr(38), ' and '), '''', '')"
    return f"list_transform(list_filter(regexp_split_to_array({s}, '[^a-z0-9]+'), lambda t: t <> ''), lambda t: coalesce(({_map(T.ADDRESS_WORDS)})[t], {number('t')}))"


SPOKEN = sorted({T.skeleton_text(w) for w in T.LEGAL_SPOKEN})
WORDS = r"list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"

DOCS = f"""doc AS MATERIALIZED (SELECT CAST(CAST(substr(source, 4) AS INT) % 3 + 1 AS BIGINT) AS src, doc_id AS id, lang AS country, text FROM documents),
raw AS MATERIALIZED (SELECT src, id, 'S' || src || '-' || id AS entity_id, country, array_to_string(({WORDS})[1:8], ' ') AS name_raw,
  array_to_string(({WORDS})[9:24], ' ') AS addr_raw FROM doc WHERE src <> 1 OR id IN (SELECT min(id) FROM doc WHERE src = 1 GROUP BY country, text))"""
RECORDS = f"""{DOCS},
nrm AS MATERIALIZED (SELECT *, regexp_matches(name_raw, '[^\\x00-\\x7F]') AS nonascii, {name_words('name_raw')} AS n, {addr_words('addr_raw')} AS a FROM raw),
cor AS MATERIALIZED (SELECT *, list_filter(n, lambda t: NOT list_contains({_list(T.LEGAL)}, t) AND NOT (nonascii AND list_contains({_list(SPOKEN)}, {skeleton('t')}))) AS c FROM nrm),
skl AS MATERIALIZED (SELECT *, list_filter(list_transform(c, lambda t: {skeleton('t')}), lambda k: length(k) >= 2) AS s FROM cor),
rec AS MATERIALIZED (SELECT src, id, entity_id, country, name_raw, addr_raw, nonascii, c, a, s, array_to_string(n, ' ') AS name_norm, array_to_string(c, ' ') AS name_core,
  array_to_string(a, ' ') AS addr_norm, array_to_string(s, ' ') AS name_skel FROM skl)"""
NUM = "regexp_full_match(t, '\\d+')"
TOKENS = f"""list_distinct(list_concat(list_concat(list_transform(list_filter(c, lambda t: NOT {NUM} AND length(t) >= 2), lambda t: 'n|' || t),
  CASE WHEN len(list_filter(c, lambda t: NOT {NUM})) >= 2 THEN ['n|' || array_to_string(list_filter(c, lambda t: NOT {NUM}), '')] ELSE [] END),
  list_concat(list_transform(s, lambda t: 'k|' || t), list_transform(list_filter(a, lambda t: {NUM} OR length(t) >= 2), lambda t: 'a|' || t))))"""
BARE = "replace(name_core, ' ', '')"
FIELD = {
    "name": f"list_distinct(list_concat(list_filter(c, lambda t: NOT {NUM} AND length(t) >= 2), CASE WHEN len(c) >= 2 AND NOT regexp_full_match({BARE}, '\\d+') AND length({BARE}) >= 2 THEN [{BARE}] ELSE [] END))",
    "skel": "list_distinct(s)",
    "addr": f"list_distinct(list_filter(a, lambda t: {NUM} OR length(t) >= 2))",
    "num": f"list_distinct(list_filter(a, lambda t: {NUM}))",
    "cng3": f"list_distinct(list_transform(range(1, greatest(length({BARE}) - 1, 1)), lambda i: substr({BARE}, i, 3)))",
    "cng4": f"list_distinct(list_transform(range(1, greatest(length({BARE}) - 2, 1)), lambda i: substr({BARE}, i, 4)))",
}


def weights(tokens: str = TOKENS, p: str = "") -> str:
    return f"""{p}tok AS MATERIALIZED (SELECT src, id, country, unnest({tokens}) AS token FROM rec),
{p}nn AS (SELECT country, count(*) AS n FROM rec WHERE src = 1 GROUP BY country),
{p}idf AS MATERIALIZED (SELECT country, token, df, n, ln((n + 1) / df) AS idf FROM (SELECT country, token, count(*) AS df FROM {p}tok WHERE src = 1 GROUP BY ALL) JOIN {p}nn USING (country)),
{p}ix AS MATERIALIZED (SELECT country, token, id AS s1_id, df, idf / (sqrt(sum(idf * idf) OVER (PARTITION BY id)) + 1e-9) AS ws FROM {p}tok JOIN {p}idf USING (country, token) WHERE src = 1),
{p}qx AS (SELECT t.src, t.id, t.country, t.token, df, coalesce(idf, ln(nn.n + 1)) AS x FROM {p}tok t JOIN {p}nn nn ON t.country = nn.country LEFT JOIN {p}idf i ON t.country = i.country AND t.token = i.token WHERE t.src > 1),
{p}qw AS MATERIALIZED (SELECT src AS q_src, id AS q_id, country, token, df, x / (sqrt(sum(x * x) OVER (PARTITION BY src, id)) + 1e-9) AS wq FROM {p}qx)"""


def pairs(cap: int = CAP, p: str = "", rerank: bool = False) -> str:
    made = f"SELECT q_src, q_id, s1_id, sum(wq * ws) AS x FROM {p}ix JOIN {p}qw USING (country, token) WHERE {p}ix.df <= {cap} GROUP BY ALL"
    if not rerank:
        return f"{p}pr AS MATERIALIZED (SELECT q_src, q_id, s1_id, round(x, 6) AS bscore FROM ({made}))"
    return f"""{p}pm AS MATERIALIZED ({made}),
{p}more AS (SELECT q_src, q_id, s1_id, sum(wq * ws) AS y FROM {p}ix JOIN {p}qw USING (country, token) JOIN {p}pm USING (q_src, q_id, s1_id) WHERE {p}ix.df > {cap} GROUP BY ALL),
{p}pr AS MATERIALIZED (SELECT q_src, q_id, s1_id, round(x + coalesce(y, 0), 6) AS bscore FROM {p}pm LEFT JOIN {p}more USING (q_src, q_id, s1_id))"""


def top(k: int = K, rel: float = REL, p: str = "") -> str:
    return f"""{p}cand AS MATERIALIZED (SELECT q_src, q_id, s1_id, bscore, rn - 1 AS brank FROM (
  SELECT *, row_number() OVER (PARTITION BY q_src, q_id ORDER BY bscore DESC, s1_id) AS rn FROM (
    SELECT *, max(bscore) OVER (PARTITION BY q_src, q_id) AS best FROM {p}pr) WHERE bscore >= {rel} * best) WHERE rn <= {k})"""


CANDS = ",\n".join([RECORDS, weights(), pairs(), top()])
SUPER = ",\n".join([RECORDS, weights(), pairs(), top(50, 0.2)])
TRUTH = f"""hd AS (SELECT src, id, country, substr(text, 1, {SEEN}) AS head FROM doc),
truth AS MATERIALIZED (SELECT h.src AS q_src, h.id AS q_id, s1_id FROM hd h JOIN (SELECT country, head, min(id) AS s1_id FROM hd WHERE src = 1 GROUP BY ALL) o
  ON h.country = o.country AND h.head = o.head WHERE h.src > 1)"""
PLANTED = TRUTH.replace("truth AS MATERIALIZED (", "truth AS MATERIALIZED (SELECT * FROM (") + """ UNION SELECT q.src, q.id, e.s1_id FROM doc q JOIN (SELECT country, min(id) AS s1_id FROM doc WHERE src = 1 GROUP BY country) e
  ON q.country = e.country WHERE q.src > 1 AND q.id % 7 = 0)"""
NUMBERED = RECORDS.replace("[9:24], ' ') AS addr_raw", "[9:24], ' ') || ' ' || (id % 97) AS addr_raw")
FOLD = "((id % 4294967296) * 2654435761 % 4294967296) % 5"
ENT = f"ent AS MATERIALIZED (SELECT id AS s1_id, country, {FOLD} AS fold FROM raw WHERE src = 1)"


def jacc(a: str, b: str) -> str:
    a, b = f"list_distinct({a})", f"list_distinct({b})"
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN -1.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"


def split(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


SIDES = """sd AS MATERIALIZED (SELECT c.*, e.name_norm AS name1, e.name_core AS core1, e.addr_norm AS addr1, e.name_skel AS skel1, q.name_norm AS name2, q.name_core AS core2, q.addr_norm AS addr2,
  q.name_skel AS skel2, q.nonascii AS nonascii2 FROM cand c JOIN rec e ON e.src = 1 AND e.id = c.s1_id JOIN rec q ON q.src = c.q_src AND q.id = c.q_id)"""
N1, N2 = (f"regexp_extract_all(addr{i}, '\\b\\d+\\b')" for i in (1, 2))
SETS = f"""{jacc(N1, N2)} AS num_jacc, CAST(CASE WHEN len({N1}) = 0 OR len({N2}) = 0 THEN -1 WHEN ({N1})[1] = ({N2})[1] THEN 1 ELSE 0 END AS DOUBLE) AS num_first_eq,
  CAST(len(list_distinct({N1})) AS BIGINT) AS num_n1, CAST(len(list_distinct({N2})) AS BIGINT) AS num_n2, {jacc(split('addr1'), split('addr2'))} AS addr_jacc, {jacc(split('core1'), split('core2'))} AS core_jacc,
  {jacc(split('skel1'), split('skel2'))} AS skel_jacc, CAST(len({split('core1')}) AS BIGINT) AS core_len1, CAST(len({split('core2')}) AS BIGINT) AS core_len2, CAST(addr2 = '' AS BIGINT) AS addr_empty2"""
#: Places of a pattern that one 128-bit integer holds; two of them hold any name or address here.
HALF = 120


def edits(need: str, windows: bool = False) -> str:
    """rt: (p, q, r) with the ratio of each pair of ``need`` (p, q), or the best of the shorter one against its windows.

    The common subsequence's length comes from a bit-parallel addition over two integers, a step a character.
    """
    pattern = "string_split(a, '')"
    half = lambda k: f"list_sum(list_transform({pattern}, lambda x, i: CASE WHEN x = c AND (i - 1) // {HALF} = {k} THEN CAST(1 AS HUGEINT) << ((i - 1) % {HALF}) ELSE CAST(0 AS HUGEINT) END))"
    full = lambda k: f"(CAST(1 AS HUGEINT) << greatest(least(length(a) - {k * HALF}, {HALF}), 0)) - 1"
    step = f"""lambda s, m: {{'lo': ((s.lo + (s.lo & m.lo)) | (s.lo - (s.lo & m.lo))) & f0, 'hi': ((s.hi + (s.hi & m.hi) + ((s.lo + (s.lo & m.lo)) >> {HALF})) | (s.hi - (s.hi & m.hi))) & f1}}"""
    head = f"""need AS MATERIALIZED (SELECT DISTINCT p, q FROM ({need})),
od AS (SELECT p, q, CASE WHEN length(p) <= length(q) THEN p ELSE q END AS a, CASE WHEN length(p) <= length(q) THEN q ELSE p END AS b FROM need),
ab AS (SELECT DISTINCT a, b FROM od UNION SELECT b, a FROM od WHERE length(a) = length(b)),
mk AS MATERIALIZED (SELECT a, b, {full(0)} AS f0, {full(1)} AS f1,
  list_transform(string_split(b, ''), lambda c: {{'lo': {half(0)}, 'hi': {half(1)}}}) AS ms FROM ab WHERE length(a) > 0)"""
    if not windows:
        return f"""{head},
lc AS MATERIALIZED (SELECT a, b, length(a) - bit_count(z.lo) - bit_count(z.hi) AS n FROM (SELECT a, b, list_reduce(list_concat([{{'lo': f0, 'hi': f1}}], ms), {step}) AS z FROM mk)),
rt AS MATERIALIZED (SELECT p, q, CASE WHEN length(b) = 0 THEN 100.0 ELSE 200.0 * coalesce(n, 0) / (length(a) + length(b)) END AS r FROM od LEFT JOIN lc USING (a, b))"""
    return f"""{head},
wn AS (SELECT a, b, f0, f1, unnest(range(1 - length(a), length(b))) AS i, ms FROM mk),
wl AS (SELECT a, b, least(i + length(a), length(b)) - greatest(i, 0) AS l, list_reduce(list_concat([{{'lo': f0, 'hi': f1}}], ms[greatest(i, 0) + 1 : i + length(a)]), {step}) AS z FROM wn),
lc AS MATERIALIZED (SELECT a, b, max(200.0 * (length(a) - bit_count(z.lo) - bit_count(z.hi)) / (length(a) + l)) AS r FROM wl GROUP BY a, b),
rt AS MATERIALIZED (SELECT od.p, od.q, CASE WHEN length(od.a) = 0 THEN CASE WHEN length(od.b) = 0 THEN 100.0 ELSE 0.0 END WHEN length(od.a) = length(od.b) THEN greatest(x.r, y.r) ELSE x.r END AS r
  FROM od LEFT JOIN lc x ON x.a = od.a AND x.b = od.b LEFT JOIN lc y ON y.a = od.b AND y.b = od.a)"""


def ordered(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({x}, ' '), lambda t: t <> '')), ' ')"


EDIT_FIELDS = ("name", "core", "addr")


def both_sides(fields: tuple[str, ...] = EDIT_FIELDS, of: str = "{}") -> str:
    return " UNION ALL ".join(f"SELECT {of.format(f + '1')} AS p, {of.format(f + '2')} AS q FROM sd" for f in fields)


def token_sets(fields: tuple[str, ...]) -> str:
    """ts: (s, t) and the strings of the shared tokens, and of those with either side's own, of each pair of fields."""
    join = lambda x: f"array_to_string(list_sort({x}), ' ')"
    less = lambda x, y: join(f"list_filter({x}, lambda w: NOT list_contains({y}, w))")
    return f"""tk AS (SELECT DISTINCT s, t, list_distinct(list_filter(string_split(s, ' '), lambda w: w <> '')) AS x, list_distinct(list_filter(string_split(t, ' '), lambda w: w <> '')) AS y
  FROM ({both_sides(fields).replace(' AS p', ' AS s').replace(' AS q', ' AS t')})),
tp AS (SELECT s, t, len(x) = 0 OR len(y) = 0 AS none, {join('list_intersect(x, y)')} AS c, {less('x', 'y')} AS u, {less('y', 'x')} AS v FROM tk),
ts AS MATERIALIZED (SELECT *, trim(c || ' ' || u) AS p, trim(c || ' ' || v) AS q FROM tp)"""


#: The token set ratio of a row of ts joined with rt.
TSET = """CASE WHEN none THEN 0.0 WHEN c <> '' AND (u = '' OR v = '') THEN 100.0
  WHEN c <> '' THEN greatest(rt.r, 200.0 * length(c) / (length(c) + length(ts.p)), 200.0 * length(c) / (length(c) + length(ts.q))) ELSE rt.r END"""


def edit_query(kind: str, fields: tuple[str, ...] = EDIT_FIELDS, places: str = "round({}, 6)") -> str:
    """CTEs and the query of one kind of similarity over the candidates: q_src, q_id, s1_id and <field>_<kind>."""
    if kind == "tset":
        made = f"{token_sets(fields)}, {edits('SELECT p, q FROM ts')}, fr AS MATERIALIZED (SELECT s AS p, t AS q, {TSET} AS r FROM ts JOIN rt ON rt.p = ts.p AND rt.q = ts.q)"
        of = "{}"
    else:
        of = ordered("{}") if kind == "tsort" else "{}"
        made = f"{edits(both_sides(fields, of), kind == 'partial')}, fr AS (SELECT * FROM rt)"
    cols = ", ".join(f"{places.format(f'{f}x.r')} AS {f}_{kind}" for f in fields)
    joins = " ".join(f"JOIN fr {f}x ON {f}x.p = {of.format(f + '1')} AND {f}x.q = {of.format(f + '2')}" for f in fields)
    return f"{made} SELECT q_src, q_id, s1_id, {cols} FROM sd {joins}"


SCORED = f"""{CANDS},
{SIDES},
sc AS MATERIALIZED (SELECT q_src, q_id, s1_id, round((bscore + greatest(core_jacc, 0) + greatest(addr_jacc, 0)) / 3, 6) AS p FROM (SELECT q_src, q_id, s1_id, bscore, {SETS} FROM sd))"""
BEST = f"""{SCORED},
bq AS MATERIALIZED (SELECT q_src, q_id, max(CASE WHEN rn = 1 THEN s1_id END) AS s1_id, max(CASE WHEN rn = 1 THEN p END) AS p, coalesce(max(CASE WHEN rn = 2 THEN p END), 0) AS p2
  FROM (SELECT *, row_number() OVER (PARTITION BY q_src, q_id ORDER BY p DESC, s1_id) AS rn FROM sc) WHERE rn <= 2 GROUP BY q_src, q_id)"""


def counted(pred: str, by: str = "") -> str:
    """cn: a row an entity with ntrue, npred, tp and the two F scores."""
    return f"""pd AS ({pred}),
pn AS (SELECT p.s1_id, count(*) AS npred, count(t.s1_id) AS tp FROM pd p LEFT JOIN truth t ON p.q_src = t.q_src AND p.q_id = t.q_id AND p.s1_id = t.s1_id GROUP BY p.s1_id),
tn AS (SELECT s1_id, count(*) AS ntrue FROM truth GROUP BY s1_id),
cn0 AS (SELECT e.*, coalesce(ntrue, 0) AS ntrue, coalesce(npred, 0) AS npred, coalesce(tp, 0) AS tp FROM ent e LEFT JOIN tn ON e.s1_id = tn.s1_id LEFT JOIN pn ON e.s1_id = pn.s1_id),
cn AS MATERIALIZED (SELECT *, CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS DOUBLE) WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / npred) * (tp / ntrue) / (0.25 * (tp / npred) + tp / ntrue) END AS f05,
  CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS DOUBLE) WHEN tp = 0 THEN 0.0 ELSE 2.0 * (tp / npred) * (tp / ntrue) / (tp / npred + tp / ntrue) END AS f1 FROM cn0)"""


MACRO = """round(avg(f05), 6) AS macro_f05, round(avg(f1), 6) AS macro_f1, count(*) AS n_s1, round(CAST(sum(tp) AS DOUBLE) / greatest(sum(npred), 1), 6) AS pair_precision,
  round(CAST(sum(tp) AS DOUBLE) / greatest(sum(ntrue), 1), 6) AS pair_recall, CAST(sum(npred) - sum(tp) AS BIGINT) AS false_merges,
  round(avg(CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS DOUBLE) END), 6) AS singleton_acc, round(avg(CASE WHEN ntrue > 0 THEN f05 END), 6) AS nonsingleton_f05"""
CONTEXT = """SELECT q_src, q_id, s1_id, bscore AS ctx_bscore, CAST(brank AS DOUBLE) AS ctx_brank, round(max(bscore) OVER q - bscore, 6) AS ctx_gap_top1,
round(bscore - coalesce(max(CASE WHEN brank = 1 THEN bscore END) OVER q, 0), 6) AS ctx_gap_second, count(*) OVER q AS ctx_q_ncand, round(max(bscore) OVER s - bscore, 6) AS ctx_s1_maxscore_gap,
count(*) OVER s AS ctx_s1_ncand, count(*) FILTER (WHERE brank = 0) OVER s AS ctx_s1_ntop FROM cand WINDOW q AS (PARTITION BY q_src, q_id), s AS (PARTITION BY s1_id)"""
