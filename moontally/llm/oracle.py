"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: Copies of documents: counts per source, square roots of shares as weights, cumulative Poisson probabilities.
SOURCE_MIXING = """
WITH sized AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
shares AS (SELECT source, n, sum(n) OVER () AS t, sqrt(n / CAST(sum(n) OVER () AS DOUBLE)) AS weight FROM sized),
rates AS (SELECT source, t * weight / sum(weight) OVER () / n AS rate FROM shares),
places AS (
    SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates),
odds AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM places),
cumulated AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM odds),
drawn AS (SELECT *, CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
    / 4503599627370496.0 AS u FROM documents),
counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) FILTER (c <= u) AS n
    FROM drawn d JOIN cumulated c ON d.source IS NOT DISTINCT FROM c.source
    GROUP BY d.doc_id, d.text, d.lang, d.source, d.n_chars)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(0, n)) AS INTEGER) AS copy FROM counted
"""

#: Every window as an md5 of its words; the least document of each decides.
REPEATED_PASSAGES = """
WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
    FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM split)),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w),
old AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first_doc < doc_id),
covered AS (SELECT DISTINCT doc_id, i + k AS p FROM old, range(50) AS r(k)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
    FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT s.doc_id, len(ws) AS n_words, len(ws) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""

EMBEDDING_LINKS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id, vec_id AS root FROM vectors UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.vec_id),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
    coalesce(e.vec_id = coalesce(component_id, e.vec_id), TRUE) AS kept
FROM embeddings e LEFT JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

#: Every term of every document with its score, summed over the items' terms.
SKETCH_SEARCH = f"""
WITH split AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS ws FROM documents),
docs AS (SELECT d, doc_id, ws, len(ws) AS n FROM split WHERE len(ws) > 0),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs),
postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(ws) AS term FROM docs) GROUP BY d, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term),
wanted AS (
    SELECT i, item_id, term, count(*) AS times
    FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
    SELECT i, item_id, d, doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN docs USING (d), totals GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

#: Every run of one to four words of every piece.
PHRASE_MINING = f"""
WITH texts AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, {_LOWER.format('text')} AS t FROM documents),
pieces AS (SELECT d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
runs AS (
    SELECT lang, k, ws[i:i + k - 1] AS ids
    FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM split, (SELECT unnest([1, 2, 3, 4]) AS k))),
counts AS (SELECT lang, k, ids, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, ids, f AS a FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
    SELECT c.lang, c.ids, a, cut, l.f AS l, r.f AS r, CAST((2000000 * CAST(a AS HUGEINT)) // (l.f + r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.ids = c.ids[1:cut] JOIN counts r ON r.lang = c.lang AND r.ids = c.ids[cut + 1:c.k]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ids ORDER BY score, cut) = 1),
inside AS (
    SELECT lang, ids[i:i + m - 1] AS ids, max(a) AS most
    FROM (SELECT lang, ids, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates)) GROUP BY ALL),
kept AS (
    SELECT lowest.*, array_to_string(lowest.ids, ' ') AS phrase FROM lowest LEFT JOIN inside USING (lang, ids)
    WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang)
"""

_QUOTED = "(?m)^[ \\t]*>"
_NORMAL = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"



def _parts(text: str) -> str:
    """A text as a whole, its paragraphs and lines, and the sentences of all these, normalised."""
    blocks = f"list_concat([{text}], regexp_split_to_array({text}, '\\n[ \\t]*\\n'), string_split({text}, chr(10)))"
    blocks = f"list_transform({blocks}, lambda b: {_NORMAL.format('b')})"
    marked = "regexp_replace(regexp_replace(s, '([.!?]) ', '\\1' || chr(10), 'g'), '([。！？]) ?', '\\1' || chr(10), 'g')"
    sentences = f"flatten(list_transform({blocks}, lambda s: string_split({marked}, chr(10))))"
    return f"list_distinct(list_concat({blocks}, {sentences}))"


QUOTATION_THREADS = f"""
WITH RECURSIVE rows AS (
    SELECT conv_id, turn, role, text, coalesce(CAST(conv_id AS VARCHAR), 'null') AS conv,
    CASE WHEN regexp_matches(text, '{_QUOTED}') THEN regexp_replace(array_to_string(list_filter(string_split(text, chr(10)),
        lambda x: NOT regexp_matches(x, '^[ \\t]*>')), chr(10)), '^\\s+|\\s+$', '', 'g') ELSE text END AS body FROM conversations),
quoting AS (SELECT DISTINCT conv, turn, text FROM rows WHERE regexp_matches(text, '{_QUOTED}')),
lines AS (
    SELECT conv, turn, text, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM quoting),
levels AS (
    SELECT conv, turn, text, i, regexp_replace(line, '^[ \\t]*(>[ \\t]*)+', '') AS line,
    len(regexp_replace(regexp_extract(line, '^[ \\t]*(>[ \\t]*)+'), '[^>]', '', 'g')) AS level FROM lines),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY conv, turn, text, level ORDER BY i) AS run FROM levels),
passages AS (
    SELECT conv, turn, level, text AS id, run, string_agg(line, chr(10) ORDER BY i) AS passage FROM runs WHERE level > 0
    GROUP BY conv, turn, text, level, run),
quoted AS (SELECT conv, turn, level, id, run, unnest({_parts("passage")}) AS part FROM passages),
held AS (SELECT conv, turn, unnest({_parts("body")}) AS part FROM rows WHERE body IS NOT NULL AND turn IS NOT NULL),
originals AS (SELECT conv, part, min(turn) AS original FROM held GROUP BY ALL),
met AS (
    SELECT q.conv, q.turn, level, original FROM quoted q JOIN originals USING (conv, part) WHERE part <> '' AND original < q.turn
    QUALIFY row_number() OVER (PARTITION BY q.conv, q.turn, level, id, run ORDER BY length(part) DESC, original DESC) = 1),
links AS (
    SELECT conv, turn, original AS parent FROM met
    QUALIFY row_number() OVER (PARTITION BY conv, turn ORDER BY level, original DESC) = 1),
chains AS (
    SELECT conv, turn, parent, parent AS root, 1 AS depth FROM links
    UNION ALL SELECT c.conv, c.turn, c.parent, l.parent, c.depth + 1 FROM chains c JOIN links l ON l.conv = c.conv AND l.turn = c.root),
known AS (SELECT conv, turn, any_value(parent) AS parent, arg_max(root, depth) AS root, max(depth) AS depth FROM chains GROUP BY conv, turn)
SELECT conv_id, turn, role,
    row_number() OVER (PARTITION BY conv ORDER BY coalesce(k.root, turn) NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, md5(coalesce(text, ''))) - 1 AS position,
    k.parent, coalesce(k.root, turn) AS root, CAST(coalesce(k.depth, 0) AS BIGINT) AS depth, body,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(body, '') AS formatted
FROM rows LEFT JOIN known k USING (conv, turn)
"""

ORACLE = {
    "op2_source_mixing": SOURCE_MIXING,
    "op4_repeated_passages": REPEATED_PASSAGES,
    "op9_embedding_links": EMBEDDING_LINKS,
    "op10_quotation_threads": QUOTATION_THREADS,
    "op11_sketch_search": SKETCH_SEARCH,
    "op13_phrase_mining": PHRASE_MINING,
}
