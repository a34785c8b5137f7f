"""The queries of ``queries.py`` in DuckDB's SQL, over the same tables.

Steps that several queries share are named common table expressions; each query takes those it needs.
"""

from __future__ import annotations

from .config import Config
from .functions import constants as C
from .operators import select as S
from .operators.features import PLACES


#: The configured cap of candidates a query.
CAP = Config().scale.max_candidates_per_s1


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _case(x: str, table: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items() if a != b) + f" ELSE {x} END"


def _present(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR lower(trim({x}, ' ')) IN ('', {_in(C.NULL_WORDS)[1:-1]}) THEN '' ELSE {x} END"


def _tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def _name_tokens(x: str) -> str:
    out = f"strip_accents(lower({_present(x)}))"
    for a, b in C.NAME_LETTERS.items():
        out = f"replace({out}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g')"
    return f"list_transform({_tokens(out)}, lambda t: {_case('t', C.LEGAL_FORMS)})"


def name(x: str) -> str:
    return f"array_to_string({_name_tokens(x)}, ' ')"


def core(x: str) -> str:
    kept = f"list_filter({_name_tokens(x)}, lambda t: t NOT IN {_in(C.CORE_STOP)})"
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string({kept}, ' ') ELSE {name(x)} END"


def address(x: str) -> str:
    out = f"regexp_replace(replace(lower(strip_accents({_present(x)})), '#', ' # '), '[^\\p{{L}}\\p{{N}}_\\s,#]+', ' ', 'g')"
    words = _tokens(f"replace({out}, ',', ' , ')")
    joined = f"array_to_string(list_transform({words}, lambda t: {_case('t', C.ADDRESS_WORDS)}), ' ')"
    once = f"regexp_replace(' ' || {joined} || ' ', ' ,( ,)+ ', ' , ', 'g')"
    return f"trim(regexp_replace(trim(regexp_replace({once}, '^ , ', ' '), ' '), ' ?,$', ''), ' ')"


def ascii_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def address_core(x: str, whole: bool = False) -> str:
    return f"array_to_string(list_filter({_tokens(x) if whole else ascii_tokens(x)}, lambda t: t NOT IN {_in(C.ADDRESS_NOISE)}), ' ')"


def country(x: str) -> str:
    joined = f"array_to_string({_tokens(f'''regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g')''')}, ' ')"
    return f"CASE WHEN {joined} IN {_in(C.MISSING_COUNTRY)} THEN '' ELSE {joined} END"


def blocking(x: str, generic: bool = False) -> str:
    drop = f" AND t NOT IN {_in(C.GENERIC_ADDRESS)}" if generic else ""
    return f"list_filter({ascii_tokens(x)}, lambda t: length(t) >= 2{drop})"


def indexed(x: str, stop) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: length(t) >= 2 AND t NOT IN {_in(stop)})"


def word_grams(x: str, least: int, most: int) -> str:
    parts = []
    for n in range(least, most + 1):
        some = f"list_transform(range(1, greatest(length(w) - {n - 1}, 1) + 1), lambda i: substr(w, i, {n}))"
        parts.append(f"CASE WHEN length(w) > {n - 1}{' OR TRUE' if n == least else ''} THEN {some} ELSE [] END")
    return f"flatten(list_transform(list_transform({_tokens(x)}, lambda v: ' ' || v || ' '), lambda w: {' || '.join(f'({p})' for p in parts)}))"


# --- shared steps ---------------------------------------------------------------------------------------------------

STEPS: dict[str, tuple[list[str], str]] = {}


def step(key: str, needs: list[str], sql: str) -> None:
    STEPS[key] = (needs, sql)


def with_steps(needs: list[str], final: str) -> str:
    done: list[str] = []

    def add(key: str) -> None:
        if key not in done:
            for n in STEPS[key][0]:
                add(n)
            done.append(key)

    for key in needs:
        add(key)
    tables = ",\n".join(f"{k} AS ({STEPS[k][1]})" for k in done)
    if final.startswith("WITH_MORE "):  # a query with a table of its own
        return f"WITH {tables},\n{final.removeprefix('WITH_MORE ')}"
    return (f"WITH {tables}\n" if done else "") + final


step("docw", [], "SELECT doc_id, CAST(doc_id % 3 AS INTEGER) AS src, lang, text, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS w FROM documents")
step(
    "recs",
    ["docw"],
    """SELECT doc_id, src, CAST(doc_id // 3 + CASE WHEN src = 2 THEN ((SELECT count(*) FROM documents) + 1) // 3 ELSE 0 END AS BIGINT) AS pos,
  'S' || CAST(src + 1 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS entity_id, array_to_string(w[1:6], ' ') AS business_name,
  array_to_string(w[7:10], ' ') || CASE WHEN len(w) >= 11 THEN ', ' || array_to_string(w[11:14], ' ') ELSE '' END
  || CASE WHEN len(w) >= 15 THEN ', ' || array_to_string(w[15:16], ' ') ELSE '' END AS business_address, lang AS country FROM docw""",
)
step("normed", ["recs"], f"SELECT *, {name('business_name')} AS name_norm, {core('business_name')} AS name_core, {address('business_address')} AS addr_norm, {country('country')} AS country_norm FROM recs")
step("rows_", ["normed"], f"SELECT *, {address_core('addr_norm')} AS addr_core FROM normed")
step("q", ["rows_"], "SELECT pos AS q, * FROM rows_ WHERE src = 0")
step("p", ["rows_"], "SELECT pos AS p, * FROM rows_ WHERE src > 0")
step("universe", ["recs"], "SELECT entity_id AS entity FROM recs WHERE src = 0")
step("wsets", ["docw"], "SELECT src, 'S' || CAST(src + 1 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS id, list_distinct(w) AS w FROM docw WHERE len(w) > 0")
step(
    "truth",
    ["wsets"],
    """SELECT a.id AS entity, b.id AS match_id FROM wsets a JOIN wsets b ON a.src = 0 AND b.src > 0 AND len(b.w) >= 0.6 * len(a.w) AND len(a.w) >= 0.6 * len(b.w)
  WHERE len(list_intersect(a.w, b.w)) >= 0.6 * (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)))""",
)

# components, in steps
REGION = "(?:^|,|\\s)([A-Za-z]{2,3})\\s+(\\d{4,10})\\s*$"


def component_steps(prefix: str, source: str, needs: list[str]) -> None:
    loose = " ".join(f"WHEN len(parts) <= 1 AND len(regexp_extract_all(n, '{p}', 1)) > 0 THEN regexp_replace(regexp_extract_all(n, '{p}', 1)[-1], '\\s+', '', 'g')" for p in ("\\b(\\d{2,3}\\s?\\d{3}\\s?\\d{3})\\b", "\\b(\\d{4,10})\\b"))
    tail = "regexp_extract(coalesce(segs[-1], ''), '(\\d{3,10})\\s*$', 1)"
    step(f"{prefix}1", needs, f"SELECT doc_id, n, list_filter(list_transform(string_split(n, ' , '), lambda s: trim(s, ' ')), lambda s: s <> '') AS segs FROM {source}")
    step(f"{prefix}2", [f"{prefix}1"], f"SELECT doc_id, n, {tail} AS tail, list_filter(CASE WHEN {tail} <> '' THEN segs[1:len(segs) - 1] || [trim(regexp_replace(segs[-1], '\\d{{3,10}}\\s*$', ''), ' ')] ELSE segs END, lambda s: s <> '') AS parts FROM {prefix}1")
    step(f"{prefix}3", [f"{prefix}2"], f"SELECT doc_id, n, parts, CASE WHEN tail <> '' THEN tail WHEN regexp_extract(n, '{REGION}', 2) <> '' THEN regexp_extract(n, '{REGION}', 2) {loose} ELSE '' END AS pin FROM {prefix}2")
    step(f"{prefix}4", [f"{prefix}3"], f"SELECT doc_id, pin, list_filter(parts, lambda s: pin = '' OR regexp_replace(s, '\\s+', '', 'g') <> pin) AS c FROM {prefix}3")
    step(
        f"{prefix}5",
        [f"{prefix}4"],
        f"""SELECT doc_id, pin, {_tokens("coalesce(c[1], '')")} AS ws,
  CASE WHEN len(c) >= 3 AND len(string_split(c[-1], ' ')) <= 3 AND length(c[-1]) <= 32 AND NOT regexp_matches(c[-1], '[0-9]') THEN c[-1] WHEN len(c) = 1 THEN regexp_extract(c[1], '{REGION}', 1) ELSE '' END AS st,
  CASE WHEN len(c) >= 3 AND len(string_split(c[-1], ' ')) <= 3 AND length(c[-1]) <= 32 AND NOT regexp_matches(c[-1], '[0-9]') THEN c[-2] WHEN len(c) >= 3 THEN c[-1] WHEN len(c) = 2 THEN c[1] ELSE '' END AS ci FROM {prefix}4""",
    )
    step(
        f"{prefix}6",
        [f"{prefix}5"],
        f"""SELECT doc_id, pin, st, ci, coalesce(list_filter(list_transform(range(1, len(ws) + 1), lambda i: CASE WHEN ws[i] IN {_in(C.NUMBER_MARKERS)} THEN list_filter(ws[i + 1 : i + 2], lambda t: regexp_matches(t, '[0-9]') AND t <> pin)[1] END), lambda t: t IS NOT NULL)[1],
  CASE WHEN regexp_matches(coalesce(ws[1], ''), '[0-9]') AND length(ws[1]) <= 8 AND ws[1] <> pin THEN ws[1] ELSE '' END) AS ho FROM {prefix}5""",
    )
    clean = lambda x: f"(CASE WHEN array_to_string(list_filter({_tokens(x)}, lambda t: t NOT IN {_in(C.ADDRESS_NOISE)}), ' ') = pin THEN '' ELSE array_to_string(list_filter({_tokens(x)}, lambda t: t NOT IN {_in(C.ADDRESS_NOISE)}), ' ') END)"
    step(f"{prefix}7", [f"{prefix}6"], f"SELECT doc_id, pin, {clean('st')} AS st, {clean('ci')} AS ci, {clean('ho')} AS ho FROM {prefix}6")
    step(f"{prefix}8", [f"{prefix}7"], "SELECT doc_id, pin, st, CASE WHEN ci = st THEN '' ELSE ci END AS ci, ho FROM " + f"{prefix}7")
    step(prefix, [f"{prefix}8"], f"SELECT doc_id, pin AS pincode, CASE WHEN ho = ci OR ho = st THEN '' ELSE ho END AS house_number, ci AS city, st AS state FROM {prefix}8")


step("rown", ["rows_"], "SELECT doc_id, addr_norm AS n FROM rows_")
component_steps("places", "rown", ["rown"])
step(
    "shaped",
    ["recs"],
    f"""SELECT doc_id, {address("v")} AS n FROM (SELECT doc_id, CASE doc_id % 6
  WHEN 0 THEN d || ' ' || w[1] || ' Road, ' || w[2] || ', ' || w[3] || ' ' || lpad(d, 5, '7')
  WHEN 1 THEN 'Flat ' || d || ', ' || w[1] || ' Street, ' || w[2] || ', ' || w[3]
  WHEN 2 THEN w[1] || ' Avenue ' || w[2] || ' TX ' || lpad(d, 5, '8')
  WHEN 3 THEN 'near ' || w[1] || ', ' || w[2] || ', ' || lpad(d, 6, '4')
  WHEN 4 THEN '#' || d || '/2, Plot no ' || d || ', ' || w[1] || ', ' || w[2] || ', in'
  ELSE w[1] || ' 12 345 678 ' || w[2] END AS v
  FROM (SELECT doc_id, CAST(doc_id AS VARCHAR) AS d, string_split(business_name || ' a b c d e f', ' ') AS w FROM recs))""",
)
component_steps("shapes", "shaped", ["shaped"])


def legacy(prefix: str, tokens: str, fit: str = "p", grams: bool = False, asked: str = "q") -> list[str]:
    """Steps of unit vectors <prefix>_wp (p, term, w) and <prefix>_wq (q, term, w)."""
    tf = "(1 + ln(tf))" if grams else "tf"
    step(f"{prefix}_tp", ["p"], f"SELECT p, term, count(*) AS tf FROM (SELECT p, unnest({tokens}) AS term FROM p) GROUP BY ALL")
    step(f"{prefix}_tq", ["q"], f"SELECT q, term, count(*) AS tf FROM (SELECT q, unnest({tokens}) AS term FROM q) GROUP BY ALL")
    step(f"{prefix}_df", [f"{prefix}_tp"], f"SELECT term, count(*) AS df FROM {prefix}_tp GROUP BY term")
    n = "(SELECT count(*) FROM p)"
    inside = f"df <= {0.995 if grams else 0.7} * {n}"
    everything = "" if grams else f" OR (SELECT count(*) FROM {prefix}_df WHERE {inside}) = 0"
    step(f"{prefix}_idf", [f"{prefix}_df"], f"SELECT term, df, ln((1 + {n}) / (1 + df)) + 1 AS idf FROM {prefix}_df WHERE {inside}{everything}")
    for k in "pq":
        step(f"{prefix}_r{k}", [f"{prefix}_idf", f"{prefix}_t{k}"], f"SELECT {k}, term, {tf} * idf AS raw FROM {prefix}_t{k} JOIN {prefix}_idf USING (term)")
        step(f"{prefix}_w{k}", [f"{prefix}_r{k}"], f"SELECT {k}, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {k})) AS w FROM {prefix}_r{k}")
    step(f"{prefix}_cos", [f"{prefix}_wp", f"{prefix}_wq"], f"SELECT q, p, sum(a.w * b.w) AS score FROM {prefix}_wq a JOIN {prefix}_wp b USING (term) GROUP BY q, p")
    return [f"{prefix}_cos"]


def top(source: str, k: int, least: float | None = None) -> str:
    cut = f"WHERE round(score, 10) >= {least}" if least is not None else ""
    return f"SELECT q, p, score FROM (SELECT q, p, score FROM {source} QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(score, 10) DESC, p) <= {k}) {cut}"


legacy("ln", blocking("name_core"))
legacy("la", blocking("addr_norm", True))
legacy("lc", word_grams("name_core", 2, 5), grams=True)
step("token_name", ["ln_cos"], top("ln_cos", 150, 0.30))
step("address_token", ["la_cos"], top("la_cos", 100, 0.35))
step("tfidf_name", ["lc_cos"], top("lc_cos", 40, 0.20))
step("csize", ["p"], "SELECT country_norm, count(*) AS size FROM p GROUP BY country_norm")
step("cq", ["q", "csize"], "SELECT q, q.country_norm, coalesce(size, 0) AS size FROM q LEFT JOIN csize USING (country_norm)")
step("c_in", ["ln_wp", "ln_wq", "cq", "p"], "SELECT a.q, b.p, sum(a.w * b.w) AS score FROM ln_wq a JOIN cq USING (q) JOIN ln_wp b USING (term) JOIN p ON b.p = p.p AND p.country_norm = cq.country_norm WHERE size >= 5 GROUP BY ALL")
step("c_out", ["ln_wp", "ln_wq", "cq"], "SELECT a.q, b.p, sum(a.w * b.w) AS score FROM ln_wq a JOIN cq USING (q) JOIN ln_wp b USING (term) WHERE size < 5 OR country_norm = '' GROUP BY ALL")
step("country_aware", ["c_in", "c_out"], f"SELECT q, p, max(score) AS score FROM (({top('c_in', 15)}) UNION ALL ({top('c_out', 20)})) WHERE round(score, 10) >= 0.25 GROUP BY q, p")


def exact(key: str, cap: int, least: int) -> str:
    return f"SELECT q.q, b.p, CAST(1 AS DOUBLE) AS score FROM q JOIN (SELECT p, {key} FROM p WHERE length({key}) >= {least} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY p) <= {cap}) b USING ({key})"


step("l_norm", ["q", "p"], exact("name_norm", 200, 2))
step("l_core", ["q", "p"], exact("name_core", 200, 2))
step("s_norm", ["q", "p"], exact("name_norm", 1000, 1))
step("s_core", ["q", "p"], exact("name_core", 1000, 1))
step("s_country", ["q", "p"], exact("country_norm", 50, 1))


def scale(prefix: str, tokens: str) -> None:
    step(f"{prefix}_tp", ["p"], f"SELECT p, term, count(*) AS tf FROM (SELECT p, unnest({tokens}) AS term FROM p) GROUP BY ALL")
    step(f"{prefix}_terms", [f"{prefix}_tp"], f"SELECT term, count(*) AS df, ln(1 + (SELECT count(*) FROM p) / count(*)) AS idf FROM {prefix}_tp GROUP BY term HAVING count(*) BETWEEN 2 AND 5000")
    step(f"{prefix}_post", [f"{prefix}_terms", f"{prefix}_tp"], f"SELECT p, term, tf, idf FROM {prefix}_tp JOIN {prefix}_terms USING (term)")
    step(f"{prefix}_norm", [f"{prefix}_post"], f"SELECT p, sqrt(sum(tf * idf * idf)) AS norm FROM {prefix}_post GROUP BY p")
    step(f"{prefix}_ask", ["q", f"{prefix}_terms"], f"SELECT q, i, term, df, idf FROM (SELECT q, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS term FROM (SELECT q, {tokens} AS t FROM q)) JOIN {prefix}_terms USING (term)")
    step(f"{prefix}_rank", [f"{prefix}_ask"], f"SELECT q, term, idf, row_number() OVER o AS rn, sum(df) OVER (o ROWS UNBOUNDED PRECEDING) AS spent, sqrt(sum(idf * idf) OVER (PARTITION BY q)) AS qnorm FROM {prefix}_ask WINDOW o AS (PARTITION BY q ORDER BY df, i)")


def gather(prefix: str, budget: int) -> str:
    chosen = f"SELECT q, term, qnorm, sum(idf * idf) AS w FROM {prefix}_rank WHERE rn <= 3 AND (spent <= {budget} OR rn = 1) GROUP BY ALL"
    return f"SELECT q, p, coalesce(overlap / nullif(qnorm * norm, 0), 0) AS score FROM (SELECT q, p, qnorm, sum(w) AS overlap FROM ({chosen}) JOIN {prefix}_post USING (term) GROUP BY ALL) JOIN {prefix}_norm USING (p)"


scale("sn", indexed("name_core", C.NAME_STOP))
scale("sa", indexed("addr_core", C.ADDRESS_STOP))

def indel(a: str, b: str) -> str:
    """Twice the longest common subsequence of two texts that are not empty over both lengths, by dynamic programming over lists."""
    row = f"list_reduce(range(1, length({b}) + 1), lambda done, j: done || [CASE WHEN substr({b}, j, 1) = c THEN row[j] + 1 ELSE greatest(row[j + 1], done[-1]) END], [0])"
    return f"2.0 * list_reduce(string_split({a}, ''), lambda row, c: {row}, list_transform(range(0, length({b}) + 1), lambda i: 0))[-1] / (length({a}) + length({b}))"


_START = "hex(encode(name_core))[1:12]"
step(
    "near",
    ["q", "p"],
    f"SELECT x.q, y.p, x.name_core AS a, y.name_core AS b FROM (SELECT q, name_core, {_START} AS s FROM q WHERE name_core <> '') x JOIN (SELECT p, name_core, {_START} AS s FROM p WHERE name_core <> '' QUALIFY row_number() OVER (PARTITION BY {_START} ORDER BY hex(encode(name_core)), p) <= 51) y USING (s)",
)
step("ratios", ["near"], f"SELECT a, b, {indel('a', 'b')} AS ratio FROM (SELECT DISTINCT a, b FROM near)")
step("s_sn", ["near", "ratios"], "SELECT q, p, ratio AS score FROM near JOIN ratios USING (a, b) WHERE ratio >= 0.55")
step("s_name", ["sn_rank", "sn_post", "sn_norm"], gather("sn", 3000))
step("s_addr", ["sa_rank", "sa_post", "sa_norm"], gather("sa", 1500))
_PARTS = {1: "s_norm", 2: "s_core", 4: "s_name", 8: "s_addr", 16: "s_sn", 32: "s_country"}
step("s_all", list(_PARTS.values()), " UNION ALL ".join(f"SELECT q, p, score, {b} AS bit FROM {t}" for b, t in _PARTS.items()))
_RULE = " + ".join(f"CASE WHEN mask & {C.SCALE_BITS[s]} <> 0 THEN {w} ELSE 0 END" for s, w in C.STRATEGY_WEIGHTS.items())
step("s_union", ["s_all"], f"SELECT q, p, mask, CAST({_RULE} AS DOUBLE) AS rule_score, content_score FROM (SELECT q, p, CAST(bit_or(bit) AS INTEGER) AS mask, max(score) AS content_score FROM s_all GROUP BY q, p)")
step("cand", ["s_union"], "SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY rule_score DESC, round(content_score, 10) DESC, p) - 1 AS INTEGER) AS rank FROM s_union")
step("candi", ["cand", "q", "p"], "SELECT cand.*, q.entity_id AS entity, p.entity_id AS match_id FROM cand JOIN q ON cand.q = q.q JOIN p ON cand.p = p.p")
_LPARTS = {1: "l_norm", 2: "l_core", 4: "token_name", 8: "tfidf_name", 16: "address_token", 32: "country_aware"}
step("l_all", list(_LPARTS.values()), " UNION ALL ".join(f"SELECT q, p, score, {b} AS bit FROM {t}" for b, t in _LPARTS.items()))
step("scored", ["token_name", "q", "p"], "SELECT q.entity_id AS entity, p.entity_id AS match_id, round(score, 2) AS score FROM token_name t JOIN q ON t.q = q.q JOIN p ON t.p = p.p")
step("told", ["scored", "truth"], "SELECT s.*, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS label FROM scored s LEFT JOIN truth t USING (entity, match_id)")
step("sizes", ["truth", "universe"], "SELECT entity, count(match_id) AS n_gt FROM universe LEFT JOIN truth USING (entity) GROUP BY entity")
F05 = "CASE WHEN n_pred = 0 AND n_gt = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * tp / (0.25 * n_gt + n_pred) END"
step("per", ["told", "sizes"], f"SELECT *, {F05} AS f05 FROM (SELECT s.entity, n_gt, count(t.entity) AS n_pred, CAST(coalesce(sum(label), 0) AS BIGINT) AS tp FROM sizes s LEFT JOIN (SELECT * FROM told WHERE score >= 0.6) t USING (entity) GROUP BY s.entity, n_gt)")
MACRO = """round(avg(f05), 6) AS f05, round(coalesce(avg(tp / n_pred) FILTER (n_pred > 0), 1), 6) AS macro_precision, round(coalesce(avg(tp / n_gt) FILTER (n_gt > 0), 1), 6) AS macro_recall,
  CAST(sum(n_pred) AS BIGINT) AS n_predicted, count(*) FILTER (n_pred > 0) AS entities_with_predictions, count(*) FILTER (n_gt = 0 AND n_pred > 0) AS singleton_violations,
  CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_pred - tp) AS BIGINT) AS fp, CAST(sum(n_gt - tp) AS BIGINT) AS fn"""
step("cuts", [], "SELECT CAST(round(0.01 + i * 0.01, 10) AS DOUBLE) AS threshold FROM range(99) r(i)")
step("at_cut", ["told", "sizes", "cuts"], f"SELECT *, {F05} AS f05 FROM (SELECT threshold, s.entity, n_gt, count(t.entity) AS n_pred, coalesce(sum(label), 0) AS tp FROM sizes s CROSS JOIN cuts LEFT JOIN told t ON t.entity = s.entity AND t.score >= threshold GROUP BY ALL)")
step("bps", ["told"], "SELECT DISTINCT score AS threshold FROM told")
step("at_bp", ["told", "sizes", "bps"], f"SELECT *, {F05} AS f05 FROM (SELECT threshold, s.entity, n_gt, count(t.entity) AS n_pred, coalesce(sum(label), 0) AS tp FROM sizes s CROSS JOIN bps LEFT JOIN told t ON t.entity = s.entity AND t.score >= threshold GROUP BY ALL)")
step("points", ["at_bp"], "SELECT threshold, avg(f05) AS f05, coalesce(avg(tp / n_pred) FILTER (n_pred > 0), 1) AS macro_precision, coalesce(avg(tp / n_gt) FILTER (n_gt > 0), 1) AS macro_recall, CAST(sum(n_pred) AS BIGINT) AS n_predicted, CAST(sum(tp) AS BIGINT) AS tp FROM at_bp GROUP BY threshold")
step("cscored", ["candi", "truth"], "SELECT c.entity, c.match_id, round(content_score, 6) AS score, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS label FROM candi c LEFT JOIN truth t USING (entity, match_id)")
step("cbps", ["cscored"], "SELECT threshold FROM (SELECT score AS threshold, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT score FROM cscored)) WHERE n <= 400 OR i = n - 1 OR i IN (SELECT CAST(floor(k * ((n - 1) / 399)) AS BIGINT) FROM range(399) r(k))")
step("at_cbp", ["cscored", "sizes", "cbps"], f"SELECT *, {F05} AS f05 FROM (SELECT threshold, s.entity, n_gt, count(t.entity) AS n_pred, coalesce(sum(label), 0) AS tp FROM sizes s CROSS JOIN cbps LEFT JOIN cscored t ON t.entity = s.entity AND t.score >= threshold GROUP BY ALL)")
step("spaced_points", ["at_cbp"], "SELECT threshold, avg(f05) AS f05, coalesce(avg(tp / n_pred) FILTER (n_pred > 0), 1) AS macro_precision, coalesce(avg(tp / n_gt) FILTER (n_gt > 0), 1) AS macro_recall, CAST(sum(n_pred) AS BIGINT) AS n_predicted, CAST(sum(tp) AS BIGINT) AS tp FROM at_cbp GROUP BY threshold")
step("hits", ["truth", "candi"], "SELECT t.entity, t.match_id, mask, rank FROM truth t LEFT JOIN candi c USING (entity, match_id)")
step("fpairs", ["cand"], f"SELECT q, p FROM cand WHERE rank < {CAP}")
_SIDE = ("business_name", "name_norm", "name_core", "addr_norm", "country_norm")
step("withp", ["rows_", "places"], "SELECT r.*, pincode, house_number, city, state FROM rows_ r JOIN places USING (doc_id)")
step(
    "fpair",
    ["fpairs", "withp"],
    "SELECT f.q, f.p, " + ", ".join(f"a.{c} AS q_{c}, b.{c} AS p_{c}" for c in (*_SIDE, *PLACES)) + " FROM fpairs f JOIN withp a ON a.src = 0 AND a.pos = f.q JOIN withp b ON b.src > 0 AND b.pos = f.p",
)


def cosine_steps(prefix: str, column: str, n: tuple[int, int]) -> None:
    step(f"{prefix}_t", ["q", "p"], f"SELECT k, term, count(*) AS tf FROM (SELECT k, unnest({word_grams('x', *n)}) AS term FROM (SELECT 2 * q AS k, {column} AS x FROM q UNION ALL SELECT 2 * p + 1, {column} FROM p)) GROUP BY ALL")
    rows = "((SELECT count(*) FROM q) + (SELECT count(*) FROM p))"
    step(f"{prefix}_i", [f"{prefix}_t"], f"SELECT term, ln((1 + {rows}) / (1 + count(*))) + 1 AS idf FROM {prefix}_t GROUP BY term HAVING count(*) <= 0.995 * {rows}")
    step(f"{prefix}_r", [f"{prefix}_i"], f"SELECT k, term, (1 + ln(tf)) * idf AS raw FROM {prefix}_t JOIN {prefix}_i USING (term)")
    step(f"{prefix}_w", [f"{prefix}_r"], f"SELECT k, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY k)) AS w FROM {prefix}_r")
    step(prefix, [f"{prefix}_w", "fpairs"], f"SELECT f.q, f.p, sum(a.w * b.w) AS v FROM fpairs f JOIN {prefix}_w a ON a.k = 2 * f.q JOIN {prefix}_w b ON b.k = 2 * f.p + 1 AND a.term = b.term GROUP BY f.q, f.p")


cosine_steps("cosn", "name_core", (2, 5))
cosine_steps("cosa", "addr_norm", (2, 4))


def _b(x: str) -> str:
    return f"CASE WHEN {x} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _same(a: str, b: str) -> str:
    return _b(f"{a} <> '' AND {a} = {b}")


def _jac(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect({a}, {b})) / nullif(len(list_distinct({a} || {b})), 0), 0)"


def _grams3(x: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({x}) - 2, 0) + 1), lambda i: substr({x}, i, 3)))"


def native_features() -> dict[str, str]:
    qn, pn, qa, pa = "q_name_norm", "p_name_norm", "q_addr_norm", "p_addr_norm"
    qt, pt, qat, pat = (_tokens(x) for x in (qn, pn, qa, pa))
    dig = {x: f"list_distinct(regexp_extract_all({x}, '[0-9]+'))" for x in (qn, pn, qa, pa)}
    first, last = (lambda x: f"coalesce({x}[1], '')"), (lambda x: f"coalesce({x}[-1], '')")
    shared = f"len(list_intersect({qt}, {pt}))"
    prefix = f"len(list_filter(range(1, least(length({qn}), length({pn})) + 1), lambda i: substr({qn}, 1, i) = substr({pn}, 1, i)))"
    out = {
        "name_exact_match": _same(qn, pn), "name_core_exact_match": _same("q_name_core", "p_name_core"), "name_raw_exact_match": _same("q_business_name", "p_business_name"),
        "name_prefix_match": _same(f"left({qn}, 4)", f"left({pn}, 4)"), "name_common_prefix_ratio": f"{prefix} / greatest(length({qn}), length({pn}), 1)",
        "name_jaccard": _jac(qt, pt), "name_token_overlap": f"coalesce({shared} / nullif(least(len(list_distinct({qt})), len(list_distinct({pt}))), 0), 0)",
        "name_token_containment_query": f"coalesce({shared} / nullif(len(list_distinct({qt})), 0), 0)", "name_token_containment_candidate": f"coalesce({shared} / nullif(len(list_distinct({pt})), 0), 0)",
        "name_char_ngram_jaccard": _jac(_grams3(qn), _grams3(pn)), "name_length_difference": f"CAST(abs(length({qn}) - length({pn})) AS DOUBLE)",
        "name_length_ratio": f"1 - abs(length({qn}) - length({pn})) / greatest(length({qn}), length({pn}), 1)", "name_first_token_match": _same(first(qt), first(pt)), "name_last_token_match": _same(last(qt), last(pt)),
        "name_numeric_match": _b(f"len(list_intersect({dig[qn]}, {dig[pn]})) > 0"), "name_numeric_both_present": _b(f"len({dig[qn]}) > 0 AND len({dig[pn]}) > 0"), "name_both_missing": _b(f"{qn} = '' AND {pn} = ''"),
        "address_exact_match": _same(qa, pa), "address_prefix_match": _same(f"left({qa}, 4)", f"left({pa}, 4)"), "address_jaccard": _jac(qat, pat),
        "address_token_overlap": f"coalesce(len(list_intersect({qat}, {pat})) / nullif(least(len(list_distinct({qat})), len(list_distinct({pat}))), 0), 0)",
        "address_length_difference": f"CAST(abs(length({qa}) - length({pa})) AS DOUBLE)", "address_length_ratio": f"1 - abs(length({qa}) - length({pa})) / greatest(length({qa}), length({pa}), 1)",
        "address_first_token_match": _same(first(qat), first(pat)), "address_last_token_match": _same(last(qat), last(pat)), "address_first_token_jaccard": _same(first(qat), first(pat)),
        "address_digit_overlap": _jac(dig[qa], dig[pa]), "address_digit_both_present": _b(f"len({dig[qa]}) > 0 AND len({dig[pa]}) > 0"), "address_both_missing": _b(f"{qa} = '' AND {pa} = ''"),
    }
    for x in PLACES:
        a, b = f"q_{x}", f"p_{x}"
        out |= {f"{x}_match": _same(a, b), f"{x}_both_present": _b(f"{a} <> '' AND {b} <> ''"), f"{x}_conflict": _b(f"{a} <> '' AND {b} <> '' AND {a} <> {b}")}
    a, b = "q_country_norm", "p_country_norm"
    return out | {"country_exact_match": _same(a, b), "country_conflict": _b(f"{a} <> '' AND {b} <> '' AND {a} <> {b}"), "country_missing": _b(f"{a} = '' OR {b} = ''"), "country_query_missing": _b(f"{a} = ''"), "country_candidate_missing": _b(f"{b} = ''")}


step("native", ["fpair"], "SELECT q, p, " + ", ".join(f"{e} AS {n}" for n, e in native_features().items()) + " FROM fpair")


def selected(how: S.Selection, source: str = "cand") -> str:
    """The rows of a ranked table that a configuration keeps."""
    excluded = S._bits(how.exclude_only)
    rest = sum(C.SCALE_BITS.values()) & ~excluded
    base = f"NOT (mask & {excluded} <> 0 AND mask & {rest} = 0)" if excluded else "TRUE"
    allowed = " OR ".join([*(f"mask & {C.SCALE_BITS[s]} <> 0" for s in how.always), *(f"(mask & {C.SCALE_BITS[s]} <> 0 AND n_{s} <= {k})" for s, k in how.quotas.items())]) if how.quotas else "TRUE"
    counts = "".join(f", sum(CASE WHEN mask & {C.SCALE_BITS[s]} <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY q ORDER BY rank ROWS UNBOUNDED PRECEDING) AS n_{s}" for s in how.quotas)
    a = f"SELECT *, {base} AS base{counts} FROM {source}"
    b = f"SELECT *, ({allowed}) AS allowed FROM ({a})"
    c = f"SELECT *, base AND (allowed OR NOT bool_or(allowed) OVER ()) AS keep, bool_or(base) OVER () AS some_base, bool_and(base) OVER () AS every_base FROM ({b})"
    d = f"SELECT *, sum(CASE WHEN keep THEN 1 ELSE 0 END) OVER (PARTITION BY q ORDER BY rank ROWS UNBOUNDED PRECEDING) AS left_ FROM ({c})"
    survivors = "TRUE" if how.mode == "union" else "NOT every_base" if not how.quotas else "FALSE"
    return f"SELECT q, p, mask, rank FROM ({d}) WHERE (keep AND CASE WHEN {survivors} THEN left_ <= {how.cap} ELSE rank < {how.cap} END) OR NOT some_base"


def _weights() -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS strategy, {b} AS bit, count(*) FILTER (mask = {b}) + 0.15 * count(*) FILTER (mask & {b} <> 0) AS worth FROM hits" for s, b in C.SCALE_BITS.items())


# quotas of the rule: slots in proportion to worth, four at least, none without worth; with an exact hit some go from names to addresses
step("worth", ["hits"], _weights())
step(
    "slots",
    ["worth"],
    f"""SELECT *, greatest(4, a - n) AS shift FROM (SELECT coalesce(max(slot) FILTER (strategy = 'address_token'), 0) AS a, coalesce(max(slot) FILTER (strategy = 'name_token'), 0) AS n,
  CAST(sum(CASE WHEN worth > 0 THEN 0 ELSE bit END) AS INTEGER) AS gone, {', '.join(f"max(slot) FILTER (strategy = '{s}') AS s_{s}" for s in C.SCALE_BITS)}
  FROM (SELECT *, CASE WHEN worth > 0 THEN greatest(4, round_even({CAP} * worth / (SELECT sum(worth) FROM worth), 0)) END AS slot FROM worth))""",
)


def adaptive_selected(cap: int, union: bool) -> str:
    """Rows that measured quotas keep: both quota sets over the whole query set, then one of them by query."""
    every = sum(C.SCALE_BITS.values())
    counts = ", ".join(f"sum(CASE WHEN mask & {b} <> 0 THEN 1 ELSE 0 END) OVER w AS n_{s}" for s, b in C.SCALE_BITS.items())
    a = f"SELECT *, NOT (mask & gone <> 0 AND mask & ({every} - gone) = 0) AS base, bool_or(mask & 3 <> 0) OVER (PARTITION BY q) AS exact_, {counts} FROM cand, slots WINDOW w AS (PARTITION BY q ORDER BY rank ROWS UNBOUNDED PRECEDING)"
    quota = {s: f"s_{s}" for s in C.SCALE_BITS}
    moved = quota | {"address_token": "a + shift", "name_token": "greatest(4, n - shift)"}
    allow = lambda of: "mask & 3 <> 0 OR " + " OR ".join(f"coalesce(mask & {C.SCALE_BITS[s]} <> 0 AND n_{s} <= {k}, FALSE)" for s, k in of.items())
    b = f"SELECT *, ({allow(quota)}) AS allow_0, ({allow(moved)}) AS allow_1 FROM ({a})"
    c = f"SELECT *, bool_or(base) OVER () AS some_base, base AND (allow_0 OR NOT bool_or(allow_0) OVER ()) AS keep_0, base AND (allow_1 OR NOT bool_or(allow_1) OVER ()) AS keep_1 FROM ({b})"
    d = f"SELECT *, CASE WHEN exact_ THEN keep_1 ELSE keep_0 END AS keep FROM ({c})"
    e = f"SELECT *, sum(CASE WHEN keep THEN 1 ELSE 0 END) OVER (PARTITION BY q ORDER BY rank ROWS UNBOUNDED PRECEDING) AS left_ FROM ({d})"
    return f"SELECT q, p, mask, rank FROM ({e}) WHERE keep AND {'left_ <= ' if union else 'rank < '}{cap} OR NOT some_base"


def configurations(adaptive: bool = True) -> str:
    """Measures of every named configuration over the union."""
    named = [(c.name, c.cap, selected(c) if c.quotas or c.exclude_only else f"SELECT q, p, mask, rank FROM cand WHERE rank < {c.cap}") for c in S.CONFIGURATIONS.values()]
    if adaptive:
        named += [("D", 100, adaptive_selected(100, False)), ("D2", 100, adaptive_selected(100, True))]
    one = """SELECT '{name}' AS name, {cap} AS cap, (SELECT count(*) FROM ({rows})) AS candidates, count(*) FILTER (f > 0) / count(*) AS query_recall, sum(f) / sum(n) AS pair_recall, count(*) FILTER (f = n) / count(*) AS all_pairs_recall
  FROM (SELECT h.entity, count(*) AS n, count(k.match_id) AS f FROM hits h LEFT JOIN (SELECT c.entity, c.match_id FROM candi c JOIN ({rows}) USING (q, p)) k USING (entity, match_id) GROUP BY h.entity)"""
    return " UNION ALL ".join(one.format(name=n, cap=cap, rows=rows) for n, cap, rows in named)


TEXTS = "(SELECT doc_id, lang, text AS v FROM documents)"


def _stack(pairs: list[tuple[str, str]], source: str, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS {names[0]}, {e} FROM {source}" for k, e in pairs)


def oracle_sql() -> dict[str, str]:
    raw = ("entity_id", "business_name", "business_address", "country")
    r = lambda *names: ", ".join(f"round({n}, 6) AS {n}" for n in names)
    pct = lambda c, p, name: f"round(quantile_cont({c}, {p}), 6) AS {name}"
    out: dict[str, tuple[list[str], str]] = {}
    prof = "count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS nulls, round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS null_fraction, count(*) FILTER (trim({c}, ' ') = '') AS blanks, count(DISTINCT {c}) AS n_distinct"
    out["scan_profile"] = (["recs"], _stack([(c, prof.format(c=c)) for c in raw], "recs", ("column",)).replace("AS column", 'AS "column"'))
    out["country_distribution"] = (["recs"], "SELECT src, country, count(*) AS n FROM recs GROUP BY ALL")
    out["open_set_countries"] = (["recs"], " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM (SELECT {c} FROM recs WHERE src > 0 EXCEPT SELECT {c} FROM recs WHERE src = 0)" for c in ("country", "business_name")))
    dup = [("row", raw), ("id", raw[:1]), ("name", raw[1:2]), ("name_address", raw[1:3])]
    out["duplicate_report"] = (["recs"], " UNION ALL ".join(f"SELECT '{k}' AS keys, count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeats FROM (SELECT count(*) AS n FROM recs GROUP BY {', '.join(c)} HAVING count(*) > 1)" for k, c in dup))
    lens = f"min(length({{c}})) AS shortest, {pct('length({c})', 0.25, 'p25')}, {pct('length({c})', 0.5, 'median')}, round(avg(length({{c}})), 6) AS mean, {pct('length({c})', 0.75, 'p75')}, {pct('length({c})', 0.95, 'p95')}, {pct('length({c})', 0.99, 'p99')}, max(length({{c}})) AS longest"
    out["length_stats"] = (["recs"], _stack([(c, lens.format(c=c)) for c in raw[1:3]], "recs", ("column",)).replace("AS column", 'AS "column"'))
    out["coverage"] = (["withp"], _stack([(c, f"round(avg(CASE WHEN trim({c}, ' ') <> '' THEN 1.0 ELSE 0.0 END), 6) AS coverage") for c in ("name_norm", "addr_norm", "country_norm", *PLACES)], "withp", ("column",)).replace("AS column", 'AS "column"'))
    out["id_report"] = (["recs"], "SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_of_repeated_ids, CAST(sum(n - 1) AS BIGINT) AS repeats, CAST(coalesce(sum(n) FILTER (NOT regexp_matches(entity_id, '^S[123]-[0-9]+$')), 0) AS BIGINT) AS odd_ids, (SELECT count(*) FROM recs WHERE entity_id IS NULL) AS null_ids FROM (SELECT entity_id, count(*) AS n FROM recs GROUP BY entity_id)")
    out["id_prefixes"] = (["recs"], "SELECT split_part(entity_id, '-', 1) AS prefix, count(*) AS n FROM recs GROUP BY 1")
    empties = " UNION ALL ".join(f"SELECT 'empty_{c}' AS \"check\", count(*) FILTER (trim(coalesce({c}, ''), ' ') = '') AS n FROM recs" for c in raw[1:])
    out["schema_validation"] = (["recs"], f"SELECT 'null_ids' AS \"check\", count(*) FILTER (entity_id IS NULL) AS n FROM recs UNION ALL {empties} UNION ALL SELECT 'duplicate_ids', count(entity_id) - count(DISTINCT entity_id) FROM recs")
    out["id_collision"] = (["recs"], "SELECT entity_id FROM recs WHERE src = 0 INTERSECT SELECT 'S1-' || CAST(doc_id - src AS VARCHAR) FROM recs WHERE src > 0")
    out["most_common_name"] = (["recs"], "SELECT business_name, count(*) AS n FROM recs GROUP BY 1 ORDER BY n DESC, business_name LIMIT 1")
    blocks = "SELECT {k}, n, round(sum(n) OVER (ORDER BY n DESC, {k}) / (SELECT count(*) FROM {t}), 6) AS share FROM (SELECT {k}, count(*) AS n FROM {t} WHERE lower(trim({k}, ' ')) NOT IN ('', 'na', 'nan', 'none', 'null') GROUP BY {k} ORDER BY n DESC, {k} LIMIT 20)"
    out["frequent_blocks"] = (["recs"], blocks.format(k="business_name", t="recs"))
    out["part_name_blocks"] = ([], blocks.format(k="p_name", t="part"))
    out["customer_nation_profile"] = ([], "SELECT r_name, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
    out["pool_union"] = (["recs"], "SELECT entity_id, business_name, pos, 'S' || CAST(src + 1 AS VARCHAR) AS source FROM recs WHERE src > 0")
    o = TEXTS
    out["normalize_name_norm"] = ([], f"SELECT doc_id, {name('v')} AS name_norm FROM {o}")
    out["normalize_name_core"] = ([], f"SELECT doc_id, {core('v')} AS name_core FROM {o}")
    out["normalize_address"] = ([], f"SELECT doc_id, {address('v')} AS addr_norm FROM {o}")
    out["normalize_country"] = ([], f"SELECT doc_id, {country('v')} AS country_norm FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN ' Unknown ' ELSE lang || '-É' END AS v FROM documents)")
    out["name_tokens"] = ([], f"SELECT doc_id, array_to_string({ascii_tokens('c')}, '|') AS name_tokens, array_to_string({ascii_tokens('n')}, '|') AS content_tokens FROM (SELECT doc_id, {core('v')} AS c, {name('v')} AS n FROM {o})")
    out["address_core"] = ([], f"SELECT doc_id, {address_core('n')} AS addr_core, {address_core('n', True)} AS store_addr_core FROM (SELECT doc_id, {address('v')} AS n FROM {o})")
    out["address_components"] = (["shapes"], "SELECT * FROM shapes")
    out["digit_runs"] = ([], f"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(v || ' ' || CAST(doc_id AS VARCHAR), '\\p{{Nd}}+'))), '|') AS runs FROM {o}")
    out["tokenize_generic"] = ([], f"SELECT doc_id, array_to_string({blocking('n', True)}, '|') AS tokens FROM (SELECT doc_id, {address('v')} || ' near main road' AS n FROM {o})")
    out["char_ngram_counts"] = ([], f"SELECT doc_id, CAST(len({_grams3('n')}) AS INTEGER) AS n_grams, CAST(len({word_grams('n', 2, 5)}) AS INTEGER) AS n_word_grams FROM (SELECT doc_id, {name('v')} AS n FROM {o})")
    out["truth_pairs"] = (["truth"], "SELECT entity AS s1_id, match_id FROM truth")
    out["truth_wide_parse"] = (["truth"], "SELECT DISTINCT entity, trim(unnest(string_split(ids, ',')), ' ') AS match_id FROM (SELECT entity, string_agg(match_id, ',' ORDER BY match_id) AS ids FROM truth GROUP BY entity)")
    out["truth_long_parse"] = (["truth"], "SELECT DISTINCT entity, match_id FROM truth")
    out["truth_verified"] = (["truth", "scored"], "SELECT entity, match_id FROM truth WHERE entity IN (SELECT entity FROM scored WHERE score >= 0.6)")
    out["valid_match_filter"] = (["truth", "recs"], "SELECT entity, match_id FROM truth WHERE match_id IN (SELECT entity_id FROM recs WHERE src = 1)")
    out["cardinality_histogram"] = (["sizes"], "SELECT n_gt AS n_matches, count(*) AS entities FROM sizes GROUP BY 1")
    out["cardinality_summary"] = (["sizes"], f"SELECT count(*) AS entities, CAST(sum(n_gt) AS BIGINT) AS pairs, count(*) FILTER (n_gt = 0) AS singletons, {', '.join(pct('n_gt', p, n) for p, n in ((0.25, 'p25'), (0.5, 'p50'), (0.75, 'p75'), (0.9, 'p90'), (0.99, 'p99')))} FROM sizes")
    out["term_df_legacy"] = (["ln_df"], "SELECT * FROM ln_df")
    out["idf_legacy"] = (["ln_idf"], f"SELECT term, df, {r('idf')} FROM ln_idf")
    out["term_df_scale"] = (["sn_terms"], "SELECT term, df FROM sn_terms")
    out["idf_scale"] = (["sa_terms"], f"SELECT term, df, {r('idf')} FROM sa_terms")
    out["doc_norms"] = (["sn_norm"], f"SELECT p, {r('norm')} FROM sn_norm")
    out["tfidf_weights_legacy"] = (["la_wp"], f"SELECT p, term, {r('w')} FROM la_wp")
    out["block_exact_normalized"] = (["l_norm"], "SELECT * FROM l_norm")
    out["block_exact_core"] = (["s_core"], "SELECT * FROM s_core")
    out["block_exact_capped"] = (["q", "p"], exact("name_norm", 5, 2))
    for key, table in (("block_token_name", "token_name"), ("block_address_token", "address_token"), ("block_country_aware", "country_aware"), ("block_char_tfidf", "tfidf_name"), ("gather_address", "s_addr")):
        out[key] = ([table], f"SELECT q, p, {r('score')} FROM {table}")
    out["block_country_topk"] = (["s_country"], "SELECT * FROM s_country")
    out["gather_budgeted"] = (["sn_rank", "sn_post", "sn_norm"], f"SELECT q, p, {r('score')} FROM ({gather('sn', 3000)})")
    out["block_prefix_window"] = (["near"], "SELECT q, p FROM near")
    out["block_sorted_neighbourhood"] = (["s_sn"], f"SELECT q, p, {r('score')} FROM s_sn")
    selfcos = "SELECT a.p AS q, b.p AS p, sum(a.w * b.w) AS score FROM ln_wp a JOIN ln_wp b USING (term) WHERE a.p <> b.p GROUP BY ALL"
    out["self_search"] = (["ln_wp"], f"SELECT q, p, {r('score')} FROM ({top('(' + selfcos + ')', 3)})")
    out["resolve_ids"] = (["recs"], "SELECT a.entity_id, coalesce(b.pos, -1) AS pos FROM (SELECT CASE WHEN doc_id % 4 = 0 THEN entity_id || '?' ELSE entity_id END AS entity_id FROM recs) a LEFT JOIN (SELECT entity_id, min(pos) AS pos FROM recs WHERE src > 0 GROUP BY 1) b USING (entity_id)")
    out["gather_rows"] = (["recs"], "SELECT d.doc_id AS at, CAST(d.doc_id // 2 AS BIGINT) AS rowid, entity_id, business_name FROM documents d LEFT JOIN (SELECT pos, entity_id, business_name FROM recs WHERE src = 1) ON pos = d.doc_id // 2")
    out["range_read"] = (["recs"], "SELECT pos AS rowid, entity_id FROM recs WHERE src = 2")
    out["store_rows"] = (["withp"], f"SELECT entity_id, name_norm, name_core, addr_norm, {address_core('addr_norm', True)} AS addr_core, country_norm AS country, pincode, house_number, city, state FROM withp")
    whole = "SELECT q, p, CAST(bit_or(bit) AS INTEGER) AS mask, max(score) AS score FROM l_all GROUP BY q, p"
    capped = "SELECT q, p, mask, round(score, 6) AS score FROM (SELECT *, count(*) OVER (PARTITION BY q) AS n, row_number() OVER (PARTITION BY q ORDER BY round(score, 10) DESC, p) AS rn FROM ({whole})) WHERE n <= {cap} OR rn <= {cap}"
    out["union_legacy"] = (["l_all"], f"SELECT q, p, mask, {r('score')} FROM ({whole})")
    out["union_legacy_all"] = (["l_all"], capped.format(whole=whole, cap=400))
    out["cap_legacy"] = (["l_all"], capped.format(whole=whole, cap=10))
    out["union_scale_all"] = (["cand"], f"SELECT q, p, mask, rule_score, {r('content_score')}, rank FROM cand")
    out["union_scale"] = (["cand"], f"SELECT q, p, mask, rule_score, {r('content_score')}, rank FROM cand WHERE rank < {CAP}")
    out["cap_scale"] = (["cand"], f"SELECT q, p, mask, rule_score, {r('content_score')} FROM cand WHERE rank < 100")
    for key, configuration in (("quota_rank", "C"), ("quota_union", "C2"), ("exclude_only", "E"), ("quota_exclude", "G2")):
        out[key] = (["cand"], selected(S.CONFIGURATIONS[configuration]))
    out["adaptive_quota"] = (["cand", "hits", "worth", "slots"], adaptive_selected(100, True))
    labels = " || ".join(f"CASE WHEN mask & {C.SCALE_BITS[s]} <> 0 THEN '+{s}' ELSE '' END" for s in C.REPORT_ORDER)
    out["strategy_labels"] = (["cand"], f"SELECT substr({labels}, 2) AS strategies, count(*) AS n FROM cand GROUP BY 1")
    per_query = "(SELECT u.entity, count(c.entity) AS n FROM universe u LEFT JOIN candi c USING (entity) GROUP BY u.entity)"
    out["candidate_stats"] = (["candi", "universe"], f"SELECT count(*) AS queries, CAST(sum(n) AS BIGINT) AS candidates, round(avg(n), 6) AS mean, {pct('n', 0.5, 'median')}, {pct('n', 0.95, 'p95')}, {pct('n', 0.99, 'p99')}, max(n) AS most, count(*) FILTER (n = 0) AS empty FROM {per_query}")
    out["candidate_histogram"] = (["candi", "universe"], f"SELECT n AS n_candidates, count(*) AS queries FROM {per_query} GROUP BY 1")
    out["strategy_counts"] = (["cand"], " UNION ALL ".join(f"SELECT '{s}' AS strategy, count(*) FILTER (mask & {b} <> 0) AS candidates FROM cand" for s, b in C.SCALE_BITS.items()))
    hit50 = f"(SELECT entity, match_id, CASE WHEN rank < {CAP} THEN mask END AS mask, count(*) OVER (PARTITION BY entity) AS n_gt FROM hits)"
    kinds = [
        f"SELECT 'overall' AS kind, 'all' AS item, count(*) AS pairs, count(mask) AS recovered FROM {hit50}",
        f"SELECT 'entities', 'fully_recalled', count(*), count(*) FILTER (m = n) FROM (SELECT entity, count(*) AS n, count(mask) AS m FROM {hit50} GROUP BY entity)",
        f"SELECT 'entities', 'partially_recalled', count(*), count(*) FILTER (m < n AND m > 0) FROM (SELECT entity, count(*) AS n, count(mask) AS m FROM {hit50} GROUP BY entity)",
        *(f"SELECT 'strategy', '{s}', count(*), count(*) FILTER (mask & {b} <> 0) FROM {hit50}" for s, b in C.SCALE_BITS.items()),
        f"SELECT 'source', split_part(match_id, '-', 1), count(*), count(mask) FROM {hit50} GROUP BY 2",
        f"SELECT 'cardinality', CAST(n_gt AS VARCHAR), count(*), count(mask) FROM {hit50} GROUP BY 2",
    ]
    out["candidate_recall"] = (["hits"], f"SELECT kind, item, pairs, recovered, round(recovered / pairs, 6) AS recall FROM ({' UNION ALL '.join(kinds)})")
    known = "(SELECT entity, CASE WHEN match_id LIKE 'S2-%' THEN 1 END AS known, mask FROM hits)"
    out["scale_recall"] = (["hits"], f"SELECT count(*) AS labelled, CAST(sum(n) AS BIGINT) AS pairs, CAST(sum(f) AS BIGINT) AS found, round(count(*) FILTER (f > 0) / count(*), 6) AS query_recall, round(sum(f) / sum(n), 6) AS pair_recall, round(count(*) FILTER (n > 0 AND f = n) / count(*), 6) AS all_pairs_recall FROM (SELECT entity, count(known) AS n, count(mask) FILTER (known = 1) AS f FROM {known} GROUP BY entity)")
    out["attribution"] = (
        ["hits", "cand"],
        " UNION ALL ".join(f"SELECT '{s}' AS strategy, (SELECT count(*) FROM cand WHERE mask & {b} <> 0) AS candidates, count(*) FILTER (mask & {b} <> 0) AS recovered, count(*) FILTER (mask = {b}) AS exclusive, round((count(mask) - count(*) FILTER (mask = {b})) / count(mask), 6) AS recall_without FROM hits" for s, b in C.SCALE_BITS.items()),
    )
    finder = "CASE mask " + " ".join(f"WHEN {b} THEN '{s}'" for s, b in C.SCALE_BITS.items()) + " ELSE 'several' END"
    out["rank_diagnostics"] = (["hits"], f"SELECT {finder} AS finder, count(*) AS pairs, CAST(floor(quantile_cont(rank, 0.5)) AS BIGINT) AS median_rank, CAST(floor(quantile_cont(rank, 0.9)) AS BIGINT) AS p90_rank, count(*) FILTER (rank < 50) AS recovered_at_50, count(*) FILTER (rank < 100) AS recovered_at_100, count(*) FILTER (rank < 200) AS recovered_at_200 FROM hits WHERE mask IS NOT NULL GROUP BY 1")
    out["missing_pairs"] = (["hits"], f"SELECT entity, match_id FROM hits WHERE rank IS NULL OR rank >= {CAP}")
    told = configurations()
    out["configuration_recall"] = (["cand", "candi", "hits", "worth", "slots"], f"SELECT name, cap, candidates, {r('query_recall', 'pair_recall', 'all_pairs_recall')} FROM ({told})")
    quotas = _in(n for n, c in S.CONFIGURATIONS.items() if c.quotas)
    out["frontier"] = (
        ["cand", "candi", "hits"],
        f"""WITH_MORE told AS ({configurations(False)}) SELECT t.name, t.candidates, round(t.pair_recall, 6) AS pair_recall, c.cap AS cheapest_cap, round(1 - t.candidates / c.candidates, 6) AS saved FROM told t
  LEFT JOIN told c ON c.name LIKE 'cap_%' AND c.pair_recall >= t.pair_recall WHERE t.name IN {quotas} QUALIFY row_number() OVER (PARTITION BY t.name ORDER BY c.candidates, c.cap) = 1""",
    )
    out["features_native"] = (["native"], "SELECT q, p, " + r(*native_features()) + " FROM native")
    out["features_cosine"] = (["fpairs", "cosn", "cosa"], "SELECT f.q, f.p, round(coalesce(n.v, 0), 6) AS name_tfidf_cosine, round(coalesce(a.v, 0), 6) AS address_tfidf_cosine FROM fpairs f LEFT JOIN cosn n USING (q, p) LEFT JOIN cosa a USING (q, p)")
    clipped = "SELECT x.q, x.p, least(greatest(coalesce(cn.v, 0), 0), 1) AS n, least(greatest(coalesce(ca.v, 0), 0), 1) AS a, name_exact_match > 0 AS same, address_exact_match, pincode_conflict, house_number_conflict FROM native x LEFT JOIN cosn cn USING (q, p) LEFT JOIN cosa ca USING (q, p)"
    out["features_combined"] = (
        ["native", "cosn", "cosa"],
        f"""SELECT q, p, round(sqrt(n * a), 6) AS name_address_geometric_score, round((n + a) / 2, 6) AS name_address_arithmetic_score, round(least(n, a), 6) AS name_address_min_score, round(greatest(n, a), 6) AS name_address_max_score,
  round(abs(n - a), 6) AS name_address_score_gap, {_b("same AND address_exact_match = 0")} AS exact_name_with_address_conflict, {_b("same AND pincode_conflict > 0")} AS exact_name_with_pincode_conflict, {_b("same AND house_number_conflict > 0")} AS exact_name_with_house_number_conflict FROM ({clipped})""",
    )
    out["features_indel_native"] = (["near", "ratios"], f"SELECT q, p, {r('ratio')} FROM near JOIN ratios USING (a, b)")
    in_order = lambda x: f"array_to_string(list_sort({_tokens(x)}), ' ')"
    out["features_indel"] = (
        ["near", "ratios"],
        f"""SELECT q, p, round(x.ratio, 6) AS ratio, round(y.ratio, 6) AS sorted_ratio FROM near JOIN ratios x USING (a, b)
  JOIN (SELECT a, b, {indel('c', 'd')} AS ratio FROM (SELECT DISTINCT a, b, {in_order('a')} AS c, {in_order('b')} AS d FROM near)) y USING (a, b)""",
    )
    words = "SELECT a, b, list_sort(list_distinct(x)) AS x, list_sort(list_distinct(y)) AS y FROM (SELECT DISTINCT a, b, string_split(a, ' ') AS x, string_split(b, ' ') AS y FROM near)"
    parts = f"SELECT a, b, list_filter(x, lambda t: list_contains(y, t)) AS both_, list_filter(x, lambda t: NOT list_contains(y, t)) AS rx, list_filter(y, lambda t: NOT list_contains(x, t)) AS ry FROM ({words})"
    sides = f"SELECT a, b, len(both_) > 0 AS shares, len(rx) > 0 AND len(ry) > 0 AS differ, array_to_string(both_, ' ') AS base, array_to_string(both_ || rx, ' ') AS l, array_to_string(both_ || ry, ' ') AS r FROM ({parts})"
    ratio = f"CASE WHEN shares AND NOT differ THEN 1.0 WHEN shares THEN greatest({indel('l', 'r')}, {indel('base', 'l')}, {indel('base', 'r')}) ELSE {indel('l', 'r')} END"
    out["features_token_set"] = (["near"], f"SELECT q, p, round(z.ratio, 6) AS ratio FROM near JOIN (SELECT a, b, {ratio} AS ratio FROM ({sides})) z USING (a, b)")
    out["features_jaro_winkler"] = (["near"], "SELECT q, p, round(jaro_winkler_similarity(a, b), 6) AS similarity FROM near")
    out["pair_labels"] = (["candi", "truth"], "SELECT c.entity AS s1_id, c.match_id, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS label FROM candi c LEFT JOIN truth t USING (entity, match_id) WHERE rank < " + str(CAP))
    means = ("name_jaccard", "address_jaccard", "country_exact_match", "name_length_ratio")
    out["class_means"] = (["native", "q", "p", "truth"], f"SELECT label, {', '.join(f'round(avg({c}), 6) AS {c}' for c in means)} FROM (SELECT native.*, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS label FROM native JOIN q ON native.q = q.q JOIN p ON native.p = p.p LEFT JOIN truth t ON t.entity = q.entity_id AND t.match_id = p.entity_id) GROUP BY label")
    out["constant_features"] = (["native"], "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(stddev_pop({c}), 6) AS deviation FROM native" for c in ("name_both_missing", "country_missing", "name_jaccard", "country_exact_match")) + ") WHERE deviation < 1e-9")
    out["f05_per_entity"] = (["per"], f"SELECT entity, n_gt, n_pred, tp, {r('f05')} FROM per")
    out["f05_macro"] = (["per"], f"SELECT {MACRO} FROM per")
    out["threshold_sweep"] = (["at_cut"], f"SELECT round(threshold, 6) AS threshold, {MACRO} FROM at_cut GROUP BY threshold")
    point = f"{r('threshold', 'f05', 'macro_precision', 'macro_recall')}, n_predicted, tp"
    out["breakpoint_sweep"] = (["points"], f"SELECT {point} FROM points")
    out["best_threshold"] = (["points"], f"SELECT {point} FROM points WHERE round((SELECT max(f05) FROM points) - points.f05, 10) <= 1e-9 ORDER BY round(points.macro_precision, 10) DESC, points.threshold DESC LIMIT 1")
    out["breakpoint_sweep_spaced"] = (["spaced_points"], f"SELECT {point} FROM spaced_points")
    out["error_buckets"] = (
        ["told", "sizes"],
        """SELECT *, round(blocking_misses / true_pairs, 6) AS blocking_rate, round(model_misses / candidate_positives, 6) AS model_rate, round(coalesce(false_merges / nullif(predictions, 0), 0), 6) AS false_merge_rate, round(singleton_violations / singletons, 6) AS singleton_rate FROM (
  SELECT CAST((SELECT sum(n_gt) FROM sizes) AS BIGINT) AS true_pairs, CAST(sum(label) AS BIGINT) AS candidate_positives, CAST((SELECT sum(n_gt) FROM sizes) - sum(label) AS BIGINT) AS blocking_misses,
  count(*) FILTER (label = 1 AND score < 0.6) AS model_misses, count(*) FILTER (label = 0 AND score >= 0.6) AS false_merges, count(*) FILTER (score >= 0.6) AS predictions, (SELECT count(*) FROM sizes WHERE n_gt = 0) AS singletons,
  (SELECT count(DISTINCT entity) FROM told JOIN sizes USING (entity) WHERE n_gt = 0 AND score >= 0.6) AS singleton_violations FROM told)""",
    )
    out["score_distribution"] = (["told"], f"SELECT label, count(*) AS n, round(avg(score), 6) AS mean, {pct('score', 0.1, 'p10')}, {pct('score', 0.5, 'p50')}, {pct('score', 0.9, 'p90')}, {pct('score', 0.99, 'p99')}, round(max(score), 6) AS most FROM told GROUP BY label")
    edges = ((0.0, 0.1), (0.1, 0.3), (0.3, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 1.01))
    values = ", ".join(f"(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in edges)
    out["calibration"] = (["told"], f"SELECT low, high, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS precision, round(avg(score), 6) AS mean_score FROM told JOIN (VALUES {values}) e(low, high) ON score >= low AND score < high GROUP BY low, high")
    out["worst_entities"] = (["per"], f"SELECT entity, n_gt, n_pred, tp, {r('f05')}, n_pred - tp AS false_merges FROM per ORDER BY per.f05, n_pred - tp DESC, entity LIMIT 25")
    emit = "SELECT u.entity AS source1_id, coalesce(string_agg(s.match_id, ',' ORDER BY s.match_id), '') AS {c} FROM universe u LEFT JOIN (SELECT * FROM scored WHERE score >= {t}) s USING (entity) GROUP BY u.entity"
    out["decide_and_emit"] = (["scored", "universe"], emit.format(c="matched_entity_ids", t=0.6))
    out["candidate_pairs_emit"] = (["scored", "universe"], emit.format(c="candidate_entity_ids", t=0))
    kept = "(SELECT * FROM scored WHERE score >= 0.6)"
    out["submission_checks"] = (
        ["scored", "universe", "recs", "address_token", "q", "p"],
        f"""SELECT 'missing_entities' AS problem, count(*) AS n FROM universe WHERE entity NOT IN (SELECT entity FROM {kept}) UNION ALL SELECT 'repeated_entities', 0 UNION ALL SELECT 'unknown_entities', 0
  UNION ALL SELECT 'unknown_matches', count(*) FROM {kept} WHERE match_id NOT IN (SELECT entity_id FROM recs WHERE src = 1)
  UNION ALL SELECT 'matches_without_candidate', count(*) FROM {kept} k ANTI JOIN (SELECT q.entity_id AS entity, p.entity_id AS match_id FROM address_token t JOIN q ON t.q = q.q JOIN p ON t.p = p.p) USING (entity, match_id)""",
    )
    sample = "SELECT q, p, CASE WHEN t.entity IS NULL THEN 0 ELSE 1 END AS label, rank FROM candi c LEFT JOIN truth t USING (entity, match_id)"
    out["training_sample"] = (["candi", "truth"], f"SELECT q, p, label FROM ({sample}) QUALIFY label = 1 OR row_number() OVER (PARTITION BY q, label ORDER BY rank, p) <= 5")
    return {key: with_steps(needs, final) for key, (needs, final) in out.items()}
