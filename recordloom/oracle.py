"""The same results in another engine's SQL. Each query names the tables of CHAIN that it needs; the chain starts from the same rendering of records."""

from __future__ import annotations

from .functions import text as T
from .operators.blocking import VIEWS, coefficients
from .operators.postings import ONE
from .queries import CFG, NONE_PE, SET_FEATURES, STRUCTURE_FEATURES
from .sources import synth


def norm(x: str) -> str:
    plain = f"replace(replace(replace(replace(lower(strip_accents(coalesce({x}, ''))), 'ß', 'ss'), '&', ' and '), '@', ' at '), '''', '')"
    return f"trim(regexp_replace(regexp_replace({plain}, '[^0-9a-z ]+', ' ', 'g'), ' +', ' ', 'g'))"


def words(x: str) -> str:
    return f"[w for w in string_split({x}, ' ') if w <> '']"


def joined(x: str, sep: str = " ") -> str:
    return f"array_to_string({x}, '{sep}')"


ABBREVIATION = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in T.ABBREVIATIONS.items()) + " ELSE w END"
SUFFIXES = "(" + ", ".join(f"'{s}'" for s in T.LEGAL_SUFFIXES) + ")"


def expanded(x: str) -> str:
    return f"array_to_string([{ABBREVIATION} for w in string_split({x}, ' ') if w <> ''], ' ')"


CUE_AT = "CASE " + " ".join(f"WHEN instr(addr_n, ' {c} ') > 0 THEN instr(addr_n, ' {c} ') - 1 WHEN starts_with(addr_n, '{c} ') THEN 0" for c in T.LANDMARK_CUES) + " END"
BARE = "CASE WHEN ltrim(w, '0') = '' THEN '0' ELSE ltrim(w, '0') END"
MINHASH = [f"list_min([(g * {a} + {b}) % 2147483647 for g in gs])" for a, b in coefficients(CFG.lsh_bands * CFG.lsh_rows, CFG.seed)]
BANDS = ", ".join("concat_ws('-', 'name_n" + str(i) + "', " + ", ".join(MINHASH[i * CFG.lsh_rows : (i + 1) * CFG.lsh_rows]) + ")" for i in range(CFG.lsh_bands))


def grams(text: str, name: str) -> dict[str, str]:
    return {
        f"tf_{name}": f"""SELECT entity_id, source, country_n, substring(p, i, n) AS gram, count(*) AS tf FROM (
            SELECT entity_id, source, country_n, p, n, unnest(range(1, greatest(len(p) - n + 2, 1))) AS i FROM (
              SELECT entity_id, source, country_n, ' ' || unnest({words(text)}) || ' ' AS p FROM canon) CROSS JOIN (SELECT unnest([3, 4]) AS n)) GROUP BY ALL""",
        f"u_{name}": f"""SELECT t.*, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM canon)) / (1 + df)) + 1) AS u
            FROM tf_{name} t JOIN (SELECT gram, count(*) AS df FROM tf_{name} GROUP BY gram) d ON d.gram = t.gram""",
        f"post_{name}": f"SELECT entity_id, source, country_n, gram, CAST(round(u / sqrt(sum(u * u) OVER (PARTITION BY entity_id)) * {ONE}) AS BIGINT) AS w FROM u_{name}",
    }


def top(name: str, k: int) -> str:
    return f"""SELECT q, t, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, t) AS r FROM (
        SELECT a.entity_id AS q, b.entity_id AS t, CAST(CAST(sum(a.w * b.w) AS BIGINT) AS DOUBLE) / {float(ONE * ONE)!r} AS score FROM post_{name} a JOIN post_{name} b ON a.country_n = b.country_n AND a.gram = b.gram AND a.source = 1 AND b.source > 1
        GROUP BY 1, 2) WHERE score >= {CFG.threshold}) WHERE r <= {k}"""


def pair_cosine(pairs: str, name: str, out: str) -> str:
    return f"""SELECT p.*, coalesce(CAST(CAST(s.v AS BIGINT) AS DOUBLE) / {float(ONE * ONE)!r}, 0) AS {out} FROM {pairs} p LEFT JOIN (
        SELECT p.q, p.t, sum(a.w * b.w) AS v FROM {pairs} p JOIN post_{name} a ON a.entity_id = p.q JOIN post_{name} b ON b.entity_id = p.t AND a.gram = b.gram GROUP BY 1, 2) s ON s.q = p.q AND s.t = p.t"""


CHAIN: dict[str, str] = {
    "base": synth.BASE,
    "records": synth.sql(False),
    "truth": "SELECT a.entity_id AS s1_id, b.entity_id AS t_id FROM records a JOIN records b ON a.true_id = b.true_id AND a.source = 1 AND b.source > 1",
    "sizes": "SELECT r.entity_id AS q, CAST(count(t.t_id) AS INTEGER) AS n FROM records r LEFT JOIN truth t ON t.s1_id = r.entity_id WHERE r.source = 1 GROUP BY 1",
    "norm0": f"SELECT entity_id, source, business_name, business_address, {norm('country')} AS country_0, {norm('business_name')} AS name_0, {norm('business_address')} AS addr_0 FROM records",
    "norm1": f"""SELECT entity_id, source, business_name AS raw_name, business_address AS raw_addr, CASE WHEN country_0 = '' THEN 'unknown' ELSE country_0 END AS country_n,
        {expanded('name_0')} AS name_n, {expanded('addr_0')} AS addr_n FROM norm0""",
    "norm2": f"""SELECT *, trim(name_n || ' ' || addr_n) AS full_n, {words('name_n')} AS toks, [w for w in string_split(name_n, ' ') if w <> '' AND w NOT IN {SUFFIXES}] AS c0,
        {CUE_AT} AS cue, regexp_extract_all(addr_n, '[0-9]+') AS runs FROM norm1""",
    "norm3": f"SELECT *, CASE WHEN len(c0) > 0 THEN c0 ELSE toks END AS core, CASE WHEN cue IS NOT NULL THEN {words('substring(addr_n, cue + 1)')} END AS tail FROM norm2",
    "canon": f"""SELECT entity_id, source, raw_name, raw_addr, country_n, name_n, addr_n, full_n, core, {joined('core')} AS core_text, {joined('core', '')} AS nospace, coalesce(core[1], '') AS first_tok,
        array_to_string([w for w in toks if w IN {SUFFIXES} AND length(w) > 1], ' ') AS suffix,
        array_to_string([substring(w, 1, 1) for w in core if NOT regexp_matches(w, '^[0-9]+$')], '') AS acr,
        [substring(substring(w, 1, 1) || regexp_replace(substring(w, 2), '[aeiouy]', '', 'g'), 1, 4) for w in core if length(w) >= 2 AND NOT regexp_matches(w, '^[0-9]+$')] AS phon,
        CASE WHEN cue IS NULL THEN addr_n ELSE trim(substring(addr_n, 1, cue) || ' ' || array_to_string(tail[5:], ' ')) END AS addr_core,
        CASE WHEN cue IS NULL THEN '' ELSE array_to_string(tail[1:4], ' ') END AS landmark,
        list_sort(list_distinct([w for w in runs if length(w) >= 4])) AS codes, list_sort(list_distinct([{BARE} for w in runs if length(w) < 4])) AS nums,
        list_distinct(list_concat(toks, {words('addr_n')})) AS alltoks FROM norm3""",
    "idf": """SELECT t.country_n, token, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT country_n, token, count(*) AS df FROM (SELECT country_n, unnest(alltoks) AS token FROM canon) GROUP BY 1, 2) t
        JOIN (SELECT country_n, count(*) AS n FROM canon GROUP BY 1) c ON c.country_n = t.country_n""",
    "rare": """SELECT entity_id, token FROM (SELECT c.entity_id, c.token, row_number() OVER (PARTITION BY c.entity_id ORDER BY round(i.idf, 9) DESC, c.token) AS r
        FROM (SELECT entity_id, country_n, unnest(list_distinct(core)) AS token FROM canon) c JOIN idf i ON i.country_n = c.country_n AND i.token = c.token) WHERE r = 1""",
    "rkeys": """SELECT DISTINCT entity_id, source, country_n, key FROM (
        SELECT c.entity_id, source, country_n, concat_ws('|', 'pc', unnest(codes), substring(token, 1, 3)) AS key FROM canon c JOIN rare r ON r.entity_id = c.entity_id
        UNION ALL SELECT entity_id, source, country_n, concat_ws('|', 'an', acr, unnest(nums)) FROM canon WHERE length(acr) >= 2
        UNION ALL SELECT entity_id, source, country_n, concat_ws('|', 'cn', substring(nospace, 1, 8)) FROM canon WHERE length(nospace) >= 6)""",
    "fan": f"SELECT country_n AS block, key, count(*) AS n FROM rkeys WHERE source > 1 GROUP BY 1, 2 HAVING count(*) <= {CFG.key_cap}",
    "kpairs": "SELECT DISTINCT a.entity_id AS q, b.entity_id AS t FROM rkeys a JOIN rkeys b ON a.key = b.key AND a.country_n = b.country_n AND a.source = 1 AND b.source > 1 JOIN fan f ON f.block = b.country_n AND f.key = b.key",
    **grams("name_n", "name"),
    **grams("full_n", "full"),
    "npairs": top("name", CFG.k_name),
    "fpairs": top("full", CFG.k_full),
    "views": "SELECT q, t, max(n) AS found_name, max(f) AS found_full, max(k) AS found_key FROM (SELECT q, t, 1 AS n, 0 AS f, 0 AS k FROM npairs UNION ALL SELECT q, t, 0, 1, 0 FROM fpairs UNION ALL SELECT q, t, 0, 0, 1 FROM kpairs) GROUP BY 1, 2",
    "cands": "SELECT q, t FROM views",
    "scored": pair_cosine("cands", "name", "p1"),
    "cos1": pair_cosine("cands", "name", "cos_name"),
    "cosines": pair_cosine("cos1", "full", "cos_full"),
    "bands": f"""SELECT entity_id, source, country_n, unnest([{BANDS}]) AS key FROM (
        SELECT entity_id, source, country_n, list(DISTINCT CAST('0x' || substring(md5(gram), 1, 8) AS BIGINT)) AS gs FROM tf_name GROUP BY 1, 2, 3)""",
    "selected": "SELECT q, t FROM scored WHERE p1 >= 0.7",
    "per": f"""SELECT s.q, s.n, coalesce(h.pred, 0) AS pred, CASE WHEN coalesce(h.pred, 0) = 0 AND n = 0 THEN 1.0 WHEN coalesce(h.pred, 0) = 0 OR n = 0 THEN 0.0
        ELSE {1 + CFG.beta**2} * tp / ({CFG.beta**2} * n + pred) END AS f FROM sizes s LEFT JOIN (
        SELECT x.q, count(*) AS pred, count(y.t_id) AS tp FROM selected x LEFT JOIN truth y ON y.s1_id = x.q AND y.t_id = x.t GROUP BY 1) h ON h.q = s.q""",
}


def chain(last: str) -> str:
    """last, with the tables of CHAIN that it needs in front."""
    import re

    needed: list[str] = []

    def add(text: str) -> None:
        for name in CHAIN:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|from|join) {name}\b", text):
                add(CHAIN[name])
                if name not in needed:
                    needed.append(name)

    add(last)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CHAIN[n]})" for n in needed) + "\n" + last


def side(kind: str, x: str) -> str:
    return {"core": f"list_distinct({x}.core)", "all": f"{x}.alltoks", "addr": f"list_distinct({words(f'{x}.addr_core')})", "lm": f"list_distinct({words(f'{x}.landmark')})"}[kind]


def _weights() -> str:
    """Sums and maxima over token sets of a pair, by joining the pair's tokens to their weights."""
    parts = []
    for kind in ("core", "addr", "lm", "all"):
        parts.append(f"""{kind}_x AS MATERIALIZED (SELECT c.q, c.t, 'a' AS s, unnest({side(kind, 'a')}) AS token, a.country_n FROM cands c JOIN canon a ON a.entity_id = c.q
            UNION ALL SELECT c.q, c.t, 'b', unnest({side(kind, 'b')}), b.country_n FROM cands c JOIN canon b ON b.entity_id = c.t)""")
        parts.append(f"""{kind}_y AS MATERIALIZED (SELECT q, t, x.token, max(CASE WHEN s = 'a' THEN idf END) AS wa, max(CASE WHEN s = 'b' THEN idf END) AS wb
            FROM {kind}_x x JOIN idf i ON i.country_n = x.country_n AND i.token = x.token GROUP BY 1, 2, 3)""")
        parts.append(f"""{kind}_z AS MATERIALIZED (SELECT q, t, coalesce(sum(CASE WHEN wb IS NOT NULL THEN wa END), 0) AS both_w, coalesce(sum(wa), 0) AS sum_a, coalesce(sum(wb), 0) AS sum_b,
            coalesce(max(CASE WHEN wb IS NOT NULL THEN wa END), 0) AS rare, coalesce(max(CASE WHEN wb IS NULL THEN wa WHEN wa IS NULL THEN wb END), 0) AS odd FROM {kind}_y GROUP BY 1, 2)""")
    for x, y, own in (("a", "b", "wa"), ("b", "a", "wb")):
        parts.append(f"""in_{x} AS MATERIALIZED (SELECT c.q, c.t, coalesce(sum(CASE WHEN list_contains(o.alltoks, c.token) THEN {own} END), 0) AS inside, coalesce(sum({own}), 0) AS whole
            FROM core_y c JOIN canon o ON o.entity_id = c.{'t' if x == 'a' else 'q'} WHERE {own} IS NOT NULL GROUP BY 1, 2)""")
    return ",\n".join(parts)


def _share(a: str, b: str) -> str:
    return f"round(CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0 END, 6)"


def _set_sql() -> str:
    z = lambda kind, c: f"coalesce({kind}_z.{c}, 0)"
    wjac = lambda k: _share(z(k, "both_w"), f"({z(k, 'sum_a')} + {z(k, 'sum_b')} - {z(k, 'both_w')})")
    agree = lambda c: f"CAST(CASE WHEN len(a.{c}) = 0 OR len(b.{c}) = 0 THEN 0 WHEN len(list_intersect(a.{c}, b.{c})) > 0 THEN 1 ELSE -1 END AS DOUBLE)"
    jac = lambda x, y: _share(f"len(list_intersect({x}, {y}))", f"len(list_distinct(list_concat({x}, {y})))")
    columns = {
        "wjac_name": wjac("core"), "shared_rare_name": f"round({z('core', 'rare')}, 6)", "unshared_rare_name": f"round({z('core', 'odd')}, 6)", "rare_diff_name": f"round({z('core', 'rare')} - {z('core', 'odd')}, 6)",
        "cont_a_in_b": _share("coalesce(in_a.inside, 0)", "coalesce(in_a.whole, 0)"), "cont_b_in_a": _share("coalesce(in_b.inside, 0)", "coalesce(in_b.whole, 0)"),
        "wjac_addr": wjac("addr"), "shared_rare_addr": f"round({z('addr', 'rare')}, 6)", "wjac_lm": wjac("lm"), "wjac_all": wjac("all"),
        "code_agree": agree("codes"), "num_agree": agree("nums"), "n_code_shared": "CAST(len(list_intersect(a.codes, b.codes)) AS DOUBLE)", "n_num_shared": "CAST(len(list_intersect(a.nums, b.nums)) AS DOUBLE)",
        "code_jac": jac("a.codes", "b.codes"), "phon_jac": jac("list_distinct(a.phon)", "list_distinct(b.phon)"),
    }
    joins = " ".join(f"LEFT JOIN {k} ON {k}.q = c.q AND {k}.t = c.t" for k in ("core_z", "addr_z", "lm_z", "all_z", "in_a", "in_b"))
    last = f"SELECT c.q, c.t, {', '.join(f'{columns[n]} AS {n}' for n in SET_FEATURES)} FROM cands c JOIN canon a ON a.entity_id = c.q JOIN canon b ON b.entity_id = c.t {joins}"
    text = chain(last + " /* FROM idf */")
    head, tail = text.rsplit("\nSELECT c.q", 1)
    return f"{head},\n{_weights()}\nSELECT c.q{tail}".replace(" /* FROM idf */", "")


def _pairs_sql(columns: dict[str, str]) -> str:
    return chain(f"SELECT c.q, c.t, {', '.join(f'{v} AS {n}' for n, v in columns.items())} FROM cands c JOIN canon a ON a.entity_id = c.q JOIN canon b ON b.entity_id = c.t")


def _flag(x: str) -> str:
    return f"CAST(({x})::INT AS DOUBLE)"


_STRUCTURE = {
    "acr_match": _flag("length(a.acr) >= 2 AND (a.acr = b.acr OR a.acr = b.nospace OR b.acr = a.nospace)"), "suffix_equal": _flag("a.suffix = b.suffix AND a.suffix <> ''"),
    "suffix_conflict": _flag("a.suffix <> '' AND b.suffix <> '' AND a.suffix <> b.suffix"), "first_tok_equal": _flag("a.first_tok = b.first_tok AND a.first_tok <> ''"),
    "phon_first_equal": _flag("coalesce(a.phon[1], '') = coalesce(b.phon[1], '') AND coalesce(a.phon[1], '') <> ''"), "core_equal": _flag("a.nospace = b.nospace AND a.nospace <> ''"),
    "len_ratio": _share("least(length(a.core_text), length(b.core_text))", "greatest(length(a.core_text), length(b.core_text))"),
    "ntok_diff": "CAST(abs(len(list_distinct(a.core)) - len(list_distinct(b.core))) AS DOUBLE)", "a_has_addr": _flag("a.addr_core <> ''"), "b_has_addr": _flag("b.addr_core <> ''"),
    "a_n_codes": "CAST(len(a.codes) AS DOUBLE)", "b_n_codes": "CAST(len(b.codes) AS DOUBLE)", "a_name_len": "CAST(length(a.core_text) AS DOUBLE)", "b_name_len": "CAST(length(b.core_text) AS DOUBLE)",
    "src_s3": _flag("b.source = 3"),
}


def _lev(c: str) -> str:
    return f"round(CASE WHEN greatest(length(a.{c}), length(b.{c})) = 0 THEN 1.0 ELSE 1 - levenshtein(a.{c}, b.{c}) / greatest(length(a.{c}), length(b.{c})) END, 6)"


_PREFIX = """round(CASE WHEN greatest(length(a.nospace), length(b.nospace)) = 0 THEN 1.0 ELSE CAST(len([i for i in range(1, least(length(a.nospace), length(b.nospace)) + 1)
    if substring(a.nospace, 1, i) = substring(b.nospace, 1, i)]) AS DOUBLE) / greatest(length(a.nospace), length(b.nospace)) END, 6)"""
_JW = lambda c: f"round(CASE WHEN a.{c} = '' AND b.{c} = '' THEN 1.0 ELSE jaro_winkler_similarity(a.{c}, b.{c}) END, 6)"

_KEPT = f"SELECT q, t, round(p1, 6) AS p FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY p1 DESC, t) AS r FROM scored WHERE p1 >= 0.3) WHERE r <= {CFG.kmax}"
#: All sets of true candidates are listed, 2**kmax at most, and every prefix of the answer is held against each.
_EXPECTED = f"""
SELECT q, t FROM (
  SELECT c.q, c.t, c.r, e.k FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY pt DESC, t) AS r FROM clipped) c JOIN (
    SELECT q, n, arg_max(k, (ef, -k)) AS k, max(ef) AS ef FROM (
      SELECT s.q, s.n, k, CASE WHEN s.n = 1 THEN 1 - {NONE_PE} ELSE sum(s.prob * {1 + CFG.beta**2} * bit_count(s.m & ((1 << k) - 1)) / ({CFG.beta**2} * bit_count(s.m) + k)) * (1 - {NONE_PE}) / max(s.some) END AS ef
      FROM (
        SELECT l.q, l.n, m.m, 1 - list_product([1 - x for x in l.ps]) AS some, list_product([CASE WHEN (m.m >> (i - 1)) & 1 = 1 THEN l.ps[i] ELSE 1 - l.ps[i] END for i in range(1, l.n + 1)]) AS prob
        FROM (SELECT q, CAST(count(*) AS BIGINT) AS n, list(pt ORDER BY pt DESC, t) AS ps FROM clipped GROUP BY q) l JOIN (SELECT unnest(range(0, {1 << CFG.kmax})) AS m) m ON m.m < (1 << l.n)) s
      JOIN (SELECT unnest(range(1, {CFG.kmax + 1})) AS k) ON k <= s.n GROUP BY 1, 2, 3) GROUP BY 1, 2) e ON e.q = c.q
  WHERE least(1.0, {NONE_PE}) < e.ef) WHERE r <= k"""

_BY_Q, _BY_T = "OVER (PARTITION BY q ORDER BY p1 DESC, t)", "OVER (PARTITION BY t ORDER BY p1 DESC, q)"

# Longest common subsequences, a bit for each place of the first text: masks of the second text's letters, folded by one addition and subtraction each. No text has over 120 characters.
_FULL = lambda x: f"((1::HUGEINT << length({x})) - 1)"
_MASKS = lambda x, y: f"[list_sum([CASE WHEN substring({x}, i, 1) = substring({y}, j, 1) THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END for i in range(1, length({x}) + 1)])::HUGEINT for j in range(1, length({y}) + 1)]"


def _lcs(masks: str, full: str, n: str) -> str:
    return f"({n} - bit_count(list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}) & {full}))"


def _indel_tables(name: str, source: str, x: str, y: str) -> str:
    """Table name (x, y, v): the normalised indel similarity of the distinct pairs of source."""
    return f"""{name}_d AS MATERIALIZED (SELECT DISTINCT {x} AS x, {y} AS y FROM {source}),
{name}_m AS MATERIALIZED (SELECT x, y, {_FULL('x')} AS f, CASE WHEN x <> '' AND y <> '' THEN {_MASKS('x', 'y')} ELSE [] END AS ms FROM {name}_d),
{name} AS MATERIALIZED (SELECT x, y, CASE WHEN x = '' AND y = '' THEN 1.0 WHEN x = '' OR y = '' THEN 0.0 ELSE 2.0 * {_lcs('ms', 'f', 'length(x)')} / (length(x) + length(y)) END AS v FROM {name}_m)"""


def _token_set_tables(name: str, source: str, x: str, y: str) -> str:
    """Table name (x, y, v): the token-set ratio of the distinct pairs of source."""
    return f"""{name}_p AS MATERIALIZED (SELECT x, y, array_to_string(list_sort(list_intersect(a, b)), ' ') AS shared, array_to_string(list_sort([w for w in a if NOT list_contains(b, w)]), ' ') AS ox,
  array_to_string(list_sort([w for w in b if NOT list_contains(a, w)]), ' ') AS oy, len(a) > 0 AND len(b) > 0 AS filled FROM (
  SELECT x, y, list_distinct({words('x')}) AS a, list_distinct({words('y')}) AS b FROM (SELECT DISTINCT {x} AS x, {y} AS y FROM {source}))),
{name}_s AS MATERIALIZED (SELECT *, CASE WHEN shared = '' THEN ox ELSE shared || ' ' || ox END AS l, CASE WHEN shared = '' THEN oy ELSE shared || ' ' || oy END AS r FROM {name}_p),
{_indel_tables(f'{name}_i', f"{name}_s WHERE filled AND NOT (shared <> '' AND (ox = '' OR oy = ''))", 'l', 'r')},
{name} AS MATERIALIZED (SELECT s.x, s.y, CASE WHEN NOT filled THEN 0.0 WHEN shared <> '' AND (ox = '' OR oy = '') THEN 1.0 WHEN shared = '' THEN i.v
  ELSE greatest(i.v, 2.0 * length(shared) / (length(shared) + length(l)), 2.0 * length(shared) / (length(shared) + length(r))) END AS v FROM {name}_s s LEFT JOIN {name}_i i ON i.x = s.l AND i.y = s.r)"""


def _partial_tables(name: str, source: str, x: str, y: str) -> str:
    """Table name (x, y, v): the best window of the longer text against the shorter one, windows at the ends being shorter; texts of one length go both ways."""
    return f"""{name}_d AS MATERIALIZED (SELECT DISTINCT {x} AS x, {y} AS y FROM {source}),
{name}_o AS MATERIALIZED (SELECT x, y, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS b FROM {name}_d WHERE x <> '' AND y <> ''
  UNION ALL SELECT x, y, y, x FROM {name}_d WHERE length(x) = length(y) AND x <> ''),
{name}_m AS MATERIALIZED (SELECT DISTINCT a, b, {_FULL('a')} AS f, {_MASKS('a', 'b')} AS ms FROM {name}_o),
{name}_w AS MATERIALIZED (SELECT a, b, f, ms[greatest(i, 0) + 1 : least(i + length(a), length(b))] AS w FROM (SELECT *, unnest(range(1 - length(a), length(b))) AS i FROM {name}_m)),
{name}_v AS MATERIALIZED (SELECT a, b, max(2.0 * {_lcs('w', 'f', 'length(a)')} / (length(a) + len(w))) AS v FROM {name}_w GROUP BY 1, 2),
{name} AS MATERIALIZED (SELECT d.x, d.y, CASE WHEN d.x = '' AND d.y = '' THEN 1.0 ELSE coalesce(max(v.v), 0.0) END AS v FROM {name}_d d LEFT JOIN {name}_o o ON o.x = d.x AND o.y = d.y LEFT JOIN {name}_v v ON v.a = o.a AND v.b = o.b GROUP BY 1, 2)"""


def _with(last: str, tables: list[str], needs: str) -> str:
    """last behind the tables of CHAIN that it and needs name, and further ones."""
    head = chain(f"SELECT 1 FROM {needs}".replace(", ", " JOIN ")).rsplit("\nSELECT 1", 1)[0]
    return head + ",\n" + ",\n".join(tables) + "\n" + last


def _ratios_sql() -> str:
    pairs = "ab AS MATERIALIZED (SELECT c.q, c.t, a.core_text AS na, b.core_text AS nb, a.addr_core AS aa, b.addr_core AS ba, array_to_string(list_sort(" + words("a.core_text") + "), ' ') AS sa, array_to_string(list_sort(" + words("b.core_text") + "), ' ') AS sb FROM cands c JOIN canon a ON a.entity_id = c.q JOIN canon b ON b.entity_id = c.t)"
    tables = [pairs, _token_set_tables("tsn", "ab", "na", "nb"), _token_set_tables("tsa", "ab", "aa", "ba"), _indel_tables("srt", "ab", "sa", "sb"), _partial_tables("prn", "ab", "na", "nb"), _partial_tables("pra", "ab", "aa", "ba")]
    joins = " ".join(f"JOIN {t} ON {t}.x = p.{x} AND {t}.y = p.{y}" for t, x, y in (("tsn", "na", "nb"), ("tsa", "aa", "ba"), ("srt", "sa", "sb"), ("prn", "na", "nb"), ("pra", "aa", "ba")))
    return _with(f"SELECT p.q, p.t, round(tsn.v, 6) AS tsr_name, round(srt.v, 6) AS tsort_name, round(prn.v, 6) AS partial_name, round(tsa.v, 6) AS tsr_addr, round(pra.v, 6) AS partial_addr FROM ab p {joins}", tables, "cands, canon")


def _collective_sql() -> str:
    ranked = f"ranked AS MATERIALIZED (SELECT q, t, p1, row_number() {_BY_Q} AS r, CAST(count(*) FILTER (p1 >= 0.5) OVER (PARTITION BY q) AS BIGINT) AS n_confident FROM scored)"
    sib = """sib AS MATERIALIZED (SELECT x.q, x.t, s.t AS sib, coalesce(s.p1, 0) AS sp, x.n_confident, b.full_n AS fx, coalesce(c.full_n, '') AS fy, b.nospace AS nx, coalesce(c.nospace, '') AS ny FROM ranked x
  JOIN canon b ON b.entity_id = x.t LEFT JOIN ranked s ON s.q = x.q AND s.r = CASE WHEN x.r = 1 THEN 2 ELSE 1 END LEFT JOIN canon c ON c.entity_id = s.t)"""
    last = """SELECT q, t, round(tsr, 6) AS sib_full_tsr, round(CASE WHEN sib IS NULL THEN 0 WHEN nx = '' AND ny = '' THEN 1 ELSE jaro_winkler_similarity(nx, ny) END, 6) AS sib_name_jw, round(sp, 6) AS sib_p, round(tsr * sp, 6) AS sib_evidence, n_confident
FROM (SELECT s.*, CASE WHEN sib IS NULL THEN 0.0 ELSE f.v END AS tsr FROM sib s JOIN full_set f ON f.x = s.fx AND f.y = s.fy)"""
    return _with(last, [ranked, sib, _token_set_tables("full_set", "sib", "fx", "fy")], "scored, canon")


def _entity_sql() -> str:
    return _with(f"""SELECT s.q, {', '.join(f'round(CAST(coalesce({c}, 0) AS DOUBLE), 6) AS {c}' for c in ('p_max', 'p_2nd', 'p_sum', 'n_cand', 'best_wjac', 'best_code', 'best_num', 'best_mutual', 'max_cos_name', 'raw_pmax'))} FROM sizes s LEFT JOIN (
  SELECT r.q, max(p1) AS p_max, max(CASE WHEN r = 2 THEN p1 END) AS p_2nd, sum(p1) AS p_sum, count(*) AS n_cand, max(wjac_name) AS best_wjac, max(code_agree) AS best_code, max(num_agree) AS best_num,
    max((r = 1 AND rr = 1)::INT) AS best_mutual, max(cos_name) AS max_cos_name, max(cos_full) AS raw_pmax FROM ranked r JOIN ({ORACLE['pair_set_features']}) f ON f.q = r.q AND f.t = r.t GROUP BY 1) e ON e.q = s.q""",
        [f"ranked AS MATERIALIZED (SELECT *, row_number() {_BY_Q} AS r, row_number() {_BY_T} AS rr FROM (SELECT *, (cos_name + cos_full) / 2 AS p1 FROM cosines))"], "cosines, sizes")


def _number(x: str) -> str:
    return f"CAST('0x' || substring(md5({x} || ':{CFG.seed}'), 1, 8) AS BIGINT)"


_HITS = "SELECT v.*, CASE WHEN y.s1_id IS NULL THEN 0 ELSE 1 END AS y FROM views v LEFT JOIN (SELECT DISTINCT s1_id, t_id FROM truth) y ON y.s1_id = v.q AND y.t_id = v.t"

ORACLE: dict[str, str] = {
    "records_source": chain("SELECT entity_id, business_name, business_address, country, source FROM records"),
    "norm_records": chain(f"SELECT entity_id, source, country_n, name_n, addr_n, full_n, core_text, addr_core, {joined('codes')} AS codes, {joined('nums')} AS nums FROM canon"),
    "norm_documents": f"SELECT doc_id, {norm('text')} AS text_n FROM documents",
    "abbrev_expand": chain("SELECT entity_id, name_n, addr_n FROM norm1"),
    "landmark_split": chain("SELECT entity_id, addr_core, landmark FROM canon"),
    "digit_sets": chain(f"SELECT entity_id, {joined('codes')} AS codes, {joined('nums')} AS nums FROM canon"),
    "acronyms": chain("SELECT entity_id, core_text, suffix, acr, nospace, first_tok FROM canon"),
    "phonetic_skeleton": chain(f"SELECT entity_id, {joined('phon')} AS phon, coalesce(phon[1], '') AS phon_first FROM canon"),
    "idf_by_country": chain("SELECT country_n, token, df, round(idf, 6) AS idf FROM idf"),
    "rare_core_token": chain("SELECT c.entity_id, r.token FROM canon c LEFT JOIN rare r ON r.entity_id = c.entity_id"),
    "char_gram_tfidf_topk_name": chain("SELECT q, t, round(score, 6) AS score FROM npairs"),
    "char_gram_tfidf_topk_full": chain("SELECT q, t, round(score, 6) AS score FROM fpairs"),
    "exact_key_candidates": chain("SELECT q, t FROM kpairs"),
    "key_fanout_cap": chain("SELECT block, key, n FROM fan"),
    "lsh_band_candidates": chain(
        f"SELECT DISTINCT a.entity_id AS q, b.entity_id AS t FROM bands a JOIN bands b ON a.key = b.key AND a.country_n = b.country_n AND a.source = 1 AND b.source > 1 JOIN (SELECT country_n, key FROM bands WHERE source > 1 GROUP BY 1, 2 HAVING count(*) <= {CFG.lsh_cap}) f ON f.key = b.key AND f.country_n = b.country_n"
    ),
    "candidate_union_views": chain(f"SELECT q, t, {', '.join(f'found_{v}' if v in ('name', 'full', 'key') else f'0 AS found_{v}' for v in VIEWS)}, CAST(0 AS DOUBLE) AS sc_dense, found_name + found_full + found_key AS n_views FROM views"),
    "blocking_stats": chain(
        """SELECT n_pairs, round(n_pairs / n1, 6) AS avg_cand, round(1 - n_pairs / (n1 * n2), 6) AS reduction_ratio, round(hits / n_true, 6) AS completeness, round(hits / n_pairs, 6) AS precision
        FROM (SELECT count(*) AS n_pairs, count(y.s1_id) AS hits FROM views p LEFT JOIN truth y ON y.s1_id = p.q AND y.t_id = p.t), (SELECT count(*) AS n_true FROM truth),
        (SELECT count(*) FILTER (source = 1) AS n1, count(*) FILTER (source > 1) AS n2 FROM records)"""
    ),
    "per_view_recall": chain(
        f"SELECT view, CAST(sum(f) AS BIGINT) AS n_pairs, CAST(sum(f * y) AS BIGINT) AS hits, round(sum(f * y) / (SELECT count(*) FROM truth), 6) AS recall FROM (SELECT y, unnest(['name', 'full', 'key', 'lsh', 'dense']) AS view, unnest([found_name, found_full, found_key, 0, 0]) AS f FROM ({_HITS})) GROUP BY 1"
    ),
    "eda_switches": chain(
        """SELECT round(agreement, 6) AS agreement, round(uniqueness, 6) AS uniqueness, round(singletons, 6) AS singletons, largest, agreement >= 0.99 AS country_block, uniqueness >= 0.995 AS hard_assign, greatest(10, largest + 5) AS kmax
        FROM (SELECT avg((a.country_n = b.country_n)::INT) AS agreement FROM truth t JOIN canon a ON a.entity_id = t.s1_id JOIN canon b ON b.entity_id = t.t_id),
        (SELECT avg((k = 1)::INT) AS uniqueness FROM (SELECT t_id, count(DISTINCT s1_id) AS k FROM truth GROUP BY 1)), (SELECT avg((n = 0)::INT) AS singletons, CAST(max(n) AS BIGINT) AS largest FROM sizes)"""
    ),
    "match_count_hist": chain("SELECT n, count(*) AS records FROM sizes GROUP BY 1"),
    "pair_set_features": _set_sql(),
    "pair_structure_features": _pairs_sql({n: _STRUCTURE[n] for n in STRUCTURE_FEATURES}),
    "pair_levenshtein": _pairs_sql({"lev_name": _lev("core_text"), "lev_addr": _lev("addr_core")}),
    "pair_prefix_sim": _pairs_sql({"prefix_sim": _PREFIX}),
    "pair_jaro_winkler": _pairs_sql({"jw_name": _JW("core_text"), "jw_nospace": _JW("nospace")}),
    "pair_cosines": chain("SELECT q, t, round(cos_name, 6) AS cos_name, round(cos_full, 6) AS cos_full FROM cosines"),
    "context_windows": chain(
        """SELECT q, t, count(*) OVER (PARTITION BY q) AS n_cand, CAST(row_number() OVER (PARTITION BY q ORDER BY cos_name DESC, t) AS INTEGER) AS cos_name_rank, round(max(cos_name) OVER (PARTITION BY q) - cos_name, 6) AS cos_name_margin,
        CAST(row_number() OVER (PARTITION BY q ORDER BY cos_full DESC, t) AS INTEGER) AS cos_full_rank, round(max(cos_full) OVER (PARTITION BY q) - cos_full, 6) AS cos_full_margin FROM cosines"""
    ),
    "competition_windows": chain(
        f"""SELECT q, t, p1_rank, p1_margin, rev_rank, rev_n, rev_margin, (p1_rank = 1 AND rev_rank = 1)::INT AS mutual_best FROM (
        SELECT q, t, CAST(row_number() {_BY_Q} AS INTEGER) AS p1_rank, round(max(p1) OVER (PARTITION BY q) - p1, 6) AS p1_margin, CAST(row_number() {_BY_T} AS INTEGER) AS rev_rank, count(*) OVER (PARTITION BY t) AS rev_n,
        round(max(p1) OVER (PARTITION BY t) - p1, 6) AS rev_margin FROM scored)"""
    ),
    "collective_windows": chain(
        f"""SELECT x.q, x.t, coalesce(s.t, '') AS sib, round(coalesce(s.p1, 0), 6) AS sib_p, x.n_confident FROM (
        SELECT q, t, p1, row_number() {_BY_Q} AS r, CAST(count(*) FILTER (p1 >= 0.5) OVER (PARTITION BY q) AS BIGINT) AS n_confident FROM scored) x
        LEFT JOIN (SELECT q, t, p1, row_number() {_BY_Q} AS r FROM scored) s ON s.q = x.q AND s.r = CASE WHEN x.r = 1 THEN 2 ELSE 1 END"""
    ),
    "prune_topk": chain(f"SELECT q, t, round(p1, 6) AS p1 FROM (SELECT *, row_number() {_BY_Q} AS r FROM scored WHERE p1 >= 0.3) WHERE r <= {CFG.kmax}"),
    "structural_assign_soft": chain("SELECT q, t, round(p1 / greatest(1.0, sum(p1) OVER (PARTITION BY t)), 6) AS p FROM scored"),
    "structural_assign_hard": chain(
        "SELECT q, t, round(CASE WHEN p >= max(p) OVER (PARTITION BY t) - 1e-12 THEN p ELSE 0 END, 6) AS p FROM (SELECT q, t, p1 / greatest(1.0, sum(p1) OVER (PARTITION BY t)) AS p FROM scored)"
    ),
    "decide_threshold": chain("SELECT q, t FROM selected"),
    "expected_f_decision": chain("SELECT 1 FROM scored").replace("\nSELECT 1 FROM scored", f",\nkept AS MATERIALIZED ({_KEPT}),\nclipped AS MATERIALIZED (SELECT q, t, least(greatest(p, 1e-6), 1 - 1e-6) AS pt FROM kept)\n{_EXPECTED}"),
    "macro_f_overall": chain("SELECT round(avg(f), 6) AS macro_f, count(*) AS n_records FROM per"),
    "macro_f_by_country": chain("SELECT country_n, round(avg(f), 6) AS macro_f, count(*) AS n_records FROM per JOIN canon ON entity_id = q GROUP BY 1"),
    "choose_eps_quantile": chain(f"SELECT round(greatest({CFG.eps_floor}, least(coalesce(quantile_cont(p1, {1 - CFG.prune_recall}), {CFG.eps_floor}), {CFG.eps_ceiling})), 6) AS eps FROM scored JOIN truth ON s1_id = q AND t_id = t"),
    "id_list_sink": chain("SELECT r.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT t, ',' ORDER BY t), '') AS candidate_entity_ids FROM records r LEFT JOIN kpairs p ON p.q = r.entity_id WHERE r.source = 1 GROUP BY 1"),
    "truth_explode": chain("SELECT s1_id, t_id FROM truth"),
    "abbrev_mining": chain(
        f"""SELECT short, long, n FROM (SELECT *, row_number() OVER (PARTITION BY short ORDER BY n DESC, long) AS r FROM (
        SELECT short, long, count(*) AS n FROM (SELECT CASE WHEN length(x) < length(y) THEN x ELSE y END AS short, CASE WHEN length(x) < length(y) THEN y ELSE x END AS long FROM (
          SELECT unnest(da) AS x, db FROM (SELECT [w for w in ta if NOT list_contains(tb, w)] AS da, [w for w in tb if NOT list_contains(ta, w)] AS db FROM (
            SELECT list_distinct({words("concat_ws(' ', a.name_0, a.addr_0)")}) AS ta, list_distinct({words("concat_ws(' ', b.name_0, b.addr_0)")}) AS tb FROM truth t JOIN norm0 a ON a.entity_id = t.s1_id JOIN norm0 b ON b.entity_id = t.t_id))
          WHERE len(da) BETWEEN 1 AND 2 AND len(db) BETWEEN 1 AND 2), LATERAL (SELECT unnest(db) AS y) WHERE NOT regexp_matches(x, '^[0-9]+$') AND NOT regexp_matches(y, '^[0-9]+$'))
        WHERE length(short) BETWEEN 2 AND 5 AND length(long) > length(short) GROUP BY 1, 2) WHERE n >= {CFG.mined_min_count} AND starts_with(long, short)) WHERE r = 1"""
    ),
    "error_samples": chain(
        """(SELECT 'fp' AS kind, q, t FROM selected ANTI JOIN truth ON s1_id = q AND t_id = t ORDER BY q, t LIMIT 200) UNION ALL (SELECT 'fn', s1_id, t_id FROM truth ANTI JOIN selected ON s1_id = q AND t_id = t ORDER BY s1_id, t_id LIMIT 200)"""
    ),
    "submission_faults": chain(
        """SELECT 'missing row' AS fault, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'repeated row', 0 UNION ALL SELECT 'unknown record', 0 UNION ALL SELECT 'unknown target', 0
        UNION ALL SELECT 'match without candidate', count(*) FROM (SELECT s.q FROM selected s ANTI JOIN kpairs k ON k.q = s.q AND k.t = s.t)"""
    ),
    "dense_knn_topk": f"""WITH u AS (SELECT vec_id, [CAST(x AS DOUBLE) / sqrt(list_sum([CAST(y AS DOUBLE) * y for y in embedding])) for x in embedding] AS v FROM embeddings)
        SELECT q, t, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, t) AS r FROM (
        SELECT a.vec_id AS q, b.vec_id AS t, round(list_inner_product(a.v, b.v), 6) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)) WHERE r <= {CFG.k_dense}""",
    "pair_token_ratios": _ratios_sql(),
    "collective_similarity": _collective_sql(),
    "oof_fold_assignment": chain(f"SELECT q, t, CAST({_number('q')} % {CFG.n_folds} AS INTEGER) AS fold, true AS is_pool FROM kpairs"),
    "sampled_split": chain(
        f"""SELECT entity_id, business_name, business_address, country, source FROM records WHERE {_number('entity_id')} % 1000000 < 250000
        OR source > 1 AND entity_id IN (SELECT t_id FROM truth WHERE {_number('s1_id')} % 1000000 < 250000)"""
    ),
    "cross_encoder_text": chain("SELECT entity_id, '[COL] name [VAL] ' || raw_name || ' [COL] address [VAL] ' || raw_addr AS pair_text, 'query: ' || concat_ws(' | ', raw_name, raw_addr) AS dense_text FROM canon"),
}
ORACLE["entity_features"] = _entity_sql()
