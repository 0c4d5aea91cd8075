"""DuckDB SQL of the native queries that SQL can express, with the operators' own parameters."""

from __future__ import annotations

from scriptoria.llm.audit import CAPITALS, DISTINCT, WORDS
from scriptoria.llm.decontaminate import FOUND, LITERAL, NO_NAMES, SHORT, UNITS, WINDOW
from scriptoria.llm.licenses import DIGESTS, KNOWN, SPELLINGS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = f"lower(coalesce({column}, ''))"
    out = rf"regexp_replace({out}, '(^|\n)[ \t#*/;-]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)|©)[^\n]*', '\1', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, {_text(old)}, {_text(new)})"
    out = rf"regexp_replace({out}, '[\x00-\x09\x0b-\x1f !-/:-@\[-`{{-\x7f©–—‘’“”]+', ' ', 'g')"
    return rf"regexp_replace({out}, ' ?\n ?', chr(10), 'g')"


def _flat(lines: str) -> str:
    return rf"trim(regexp_replace({lines}, '[ \n]+', ' ', 'g'))"


def licenses() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in KNOWN)
    digests = ", ".join(f"({_text(name)}, {_text(digest)})" for name, digest in DIGESTS)
    return f"""WITH listed(license, text) AS (VALUES {known}), long(license, digest) AS (VALUES {digests}),
known AS (SELECT digest, min(license) AS license FROM (SELECT license, md5({_flat(_canonical('text'))}) AS digest FROM listed UNION ALL SELECT license, digest FROM long) GROUP BY 1),
canon AS (SELECT row_number() OVER () AS k, doc_id, {_canonical('text')} AS lines FROM documents),
whole AS (SELECT k, doc_id, md5({_flat('lines')}) AS digest FROM canon),
each AS (SELECT k, trim(unnest(string_split(lines, chr(10)))) AS line FROM canon),
found AS (SELECT k, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses FROM each JOIN known ON known.digest = md5(line) WHERE line <> '' GROUP BY k)
SELECT whole.doc_id, whole.digest, known.license, line_licenses FROM whole LEFT JOIN known ON known.digest = whole.digest LEFT JOIN found ON found.k = whole.k"""


def _slotted(column: str) -> str:
    out = f"translate(coalesce({column}, ''), chr(2) || chr(3) || chr(4), '   ')"
    out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}])(\p{{Lu}}[\p{{L}}\p{{M}}]*)', '\1' || chr(2) || 'n\2' || chr(3), 'g')"
    out = rf"regexp_replace({out}, '\x02n({'|'.join(NO_NAMES)})\x03', '\1', 'g')"
    out = f"replace(replace({out}, chr(3) || ' ' || chr(2) || 'n', chr(4)), chr(3), '')"
    out = rf"regexp_replace(lower({out}), '(^|[^\p{{L}}\p{{N}}])(\p{{Nd}}+(?:[.,]\p{{Nd}}+)*)', '\1' || chr(2) || 'd\2', 'g')"
    # RE2 has no look-ahead: the character after a unit is matched and put back
    out = rf"regexp_replace({out}, '(\x02d[\p{{Nd}}.,]*\p{{Nd}}) ?({'|'.join(UNITS)})([^\p{{L}}\p{{N}}]|$)', '\1 ' || chr(2) || 'u\2\3', 'g')"
    return rf"regexp_extract_all({out}, '\x02n[\p{{L}}\p{{M}}\x04]+|\x02d\p{{Nd}}+(?:[.,]\p{{Nd}}+)*|\x02?[\p{{L}}\p{{N}}]+')"


def decontaminated() -> str:
    kinds = "list_transform(ws, lambda w: CASE WHEN starts_with(w, chr(2)) THEN left(w, 2) ELSE w END)"
    plain = "list_transform(ws, lambda w: CASE WHEN starts_with(w, chr(2)) THEN substr(w, 3) ELSE w END)"
    last = lambda w: rf"regexp_replace({w}, '^\x02n.*\x04', chr(2) || 'n')"
    return f"""WITH items AS (SELECT row_number() OVER () AS ik, item_id, ws, {kinds} AS ks, {plain} AS ps, least(len(ws), {WINDOW}) AS size FROM (SELECT item_id, {_slotted('text')} AS ws FROM benchmark WHERE item_id IS NOT NULL) WHERE len(ws) > 0),
docs AS (SELECT row_number() OVER () AS dk, doc_id, ws, {kinds} AS ks, {plain} AS ps FROM (SELECT doc_id, {_slotted('text')} AS ws FROM documents WHERE doc_id IS NOT NULL)),
sizes AS (SELECT DISTINCT size FROM items),
asked AS (SELECT item_id, ik, size, item_at, len(list_filter(ws[item_at + 1 : item_at + size], lambda w: starts_with(w, chr(2)))) AS slots, ks[item_at + 1 : item_at + size] AS kw, ps[item_at + 1 : item_at + size] AS pw FROM (SELECT *, unnest(range(0, len(ks) - size + 1)) AS item_at FROM items)),
marked AS (SELECT *, slots > 0 AND size - slots < CASE WHEN size = {WINDOW} THEN {LITERAL} ELSE greatest({SHORT}, (size + 1) // 2) END AS exact FROM asked),
known AS (SELECT item_id, ik, size, item_at, slots, exact, array_to_string(CASE WHEN exact THEN pw ELSE kw END, ' ') AS win FROM marked),
placed AS (SELECT doc_id, dk, size, pos, unnest([{{'exact': false, 'win': array_to_string(ks[pos + 1 : pos + size], ' ')}}, {{'exact': true, 'win': array_to_string(ps[pos + 1 : pos + size], ' ')}}], recursive := true) FROM (SELECT doc_id, dk, ks, ps, size, unnest(range(0, len(ks) - size + 1)) AS pos FROM docs, sizes WHERE len(ks) >= size)),
hits AS (SELECT doc_id, dk, item_id, ik, size, exact, win, pos, item_at, slots, pos - item_at AS shift FROM placed JOIN known USING (size, exact, win)),
filled AS (SELECT h.doc_id, dk, item_id, ik, shift, pos, item_at, h.size, {last('i.ws[item_at + k]')} AS asked, {last('d.ws[pos + k]')} AS given FROM (SELECT *, unnest(range(1, size + 1)) AS k FROM hits WHERE slots > 0 AND NOT exact) h JOIN items i USING (item_id, ik) JOIN docs d USING (dk)),
two AS (SELECT dk, ik, shift, asked FROM filled WHERE starts_with(asked, chr(2)) GROUP BY dk, ik, shift, asked HAVING min(given) <> max(given)),
wrong AS (SELECT DISTINCT dk, ik, pos, item_at, size FROM filled JOIN two USING (dk, ik, shift, asked)),
good AS (SELECT h.* FROM hits h LEFT JOIN wrong w ON w.dk = h.dk AND w.ik = h.ik AND w.pos = h.pos AND w.item_at = h.item_at AND w.size = h.size WHERE exact OR w.dk IS NULL),
seen AS (SELECT doc_id, item_id, count(DISTINCT win) FILTER (NOT exact) AS free, count(DISTINCT win) FILTER (NOT exact AND slots > 0) AS filled, count(DISTINCT win) FILTER (exact) AS fixed FROM good GROUP BY doc_id, item_id),
whole AS (SELECT item_id, count(DISTINCT win) FILTER (NOT exact) AS n_free, count(DISTINCT win) FILTER (exact) AS n_fixed FROM known GROUP BY item_id),
judged AS (SELECT *, n_free > 0 AND free >= least({FOUND}, n_free) AS first, fixed > 0 AND free + fixed >= least({FOUND}, n_free + n_fixed) AS second FROM seen JOIN whole USING (item_id))
SELECT doc_id, item_id, free + CASE WHEN first THEN 0 ELSE fixed END AS windows, n_free + CASE WHEN first THEN 0 ELSE n_fixed END AS item_windows, filled + CASE WHEN first THEN 0 ELSE fixed END AS slots FROM judged WHERE first OR second"""


def audited() -> str:
    words = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    return f"""WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
counted AS (SELECT *, len({words}) AS n, len(list_distinct({words})) AS d, min(doc_id) OVER (PARTITION BY text) AS low FROM docs),
failed AS (SELECT k, doc_id, part, unnest(['A', 'B', 'C', 'D', 'E']) AS filter, unnest([n < {WORDS}, 100 * d < {DISTINCT} * n, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITALS} * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > low, false)]) AS fails FROM counted),
masks AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, string_agg(filter, '' ORDER BY filter) FILTER (fails) AS mask FROM failed LEFT JOIN told USING (doc_id) GROUP BY k, part, good, toxic),
cells AS (SELECT part, coalesce(mask, '') AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY ALL),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS filter, left(filter_order, step - 1) AS earlier FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
judged AS (SELECT *, contains(mask, filter) AS fails, translate(mask, earlier, '') <> mask AS gone FROM cells, steps),
figures AS (SELECT part, filter_order, step, filter, sum(n) FILTER (NOT fails AND NOT gone) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed, sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (mask = filter) AS unique_fails, sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost FROM judged GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM figures"""
