"""The registered queries once more, as SQL for DuckDB, to check results against.

Patterns, word lists and parameters are shared with the Spark expressions; the logic is written
separately. DuckDB's regular expressions know neither possessive quantifiers, which only save time
there, nor look-around: where Spark's need that, the SQL has a simpler pattern that reads the given tables alike.
"""

from __future__ import annotations

import re
from html.entities import html5

from pagevane.functions import html as H
from pagevane.functions import language as L
from pagevane.functions import segment as S
from pagevane.functions import text as T
from pagevane.functions import vectors as V
from pagevane.operators import boilerplate as P
from pagevane.operators import langmodel as M
from pagevane.operators import language as N
from pagevane.operators import nearest as K
from pagevane.operators import search as Q
from pagevane.plans import catalog as C


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def pattern(text: str) -> str:
    """SQL literal of a pattern without its possessive quantifiers and looks ahead."""
    return q(re.sub(r"([*+?])\+", r"\1", text.replace("(?==)", "")))


# Simpler than Spark's patterns: no tag before the one that counts holds markup in an attribute. Of the
# names of references the SQL knows the common ones.
NOISE = r"(?i)^<[a-z][^>]*\b(?:class|id)\s*=\s*[\"']?[^\"'>]*\b(?:" + "|".join(H.NOISE_CLASSES) + r")\b"
BLOCK = rf"(?i)(</?(?:{'|'.join(H.BLOCK_ELEMENTS)})\b[^>]*>)"
HEADING = r"(?is)<h1\b[^>]*>(.*?)(?:</?h[1-6]\b|\z)"


def in_list(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def in_list_of(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


# --- expressions -------------------------------------------------------------------


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(T.SPACE + '+')}, ' ', 'g'))"


def drop_tags(x: str, by: str) -> str:
    return f"regexp_replace({x}, {pattern(H.TAG_PATTERN)}, {q(by)}, 'g')"


def words(x: str) -> str:
    space = q(T.SPACE + "+")
    return f"len(list_filter(regexp_split_to_array({x}, {space}), lambda w: w <> ''))"


def tokens(x: str) -> str:
    pattern = q(r"[^\p{L}\p{N}]+")
    return f"list_filter(regexp_split_to_array(lower({x}), {pattern}), lambda t: t <> '')"


def unescape(x: str) -> str:
    table = {name: html5[name] for name in H.BARE_NAMES} | H.named_entities()
    named = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in sorted(table.items())) + "}"
    controls = [c for c in range(0x80, 0xA0) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    meant = f"{q(''.join(map(chr, controls)))}, {q(bytes(controls).decode('cp1252'))}"

    # Cut at the ampersands; ``p`` is a piece, which may begin with a reference.
    def number(mark: str, digit: str, most: int, prefix: str) -> str:
        digits = f"regexp_extract(p, '^#{mark}(0*{digit}{{1,{most}}})(?:{digit.replace('[', '[^')}|$)', 1)"
        code = f"TRY_CAST('{prefix}' || nullif({digits}, '') AS BIGINT)"
        valid = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111)"
        rest = f"regexp_replace(p[length({digits}) + {3 if mark else 2}:], '^;', '')"
        return f"CASE WHEN {valid} THEN translate(chr({code}::INTEGER), {meant}) || {rest} END"

    def name(found: str, skip: int) -> str:
        return f"{named}[{found}] || p[length({found}) + {skip}:]"

    decimal, hexadecimal = number("", "[0-9]", 7, ""), number("[xX]", "[0-9a-fA-F]", 6, "0x")
    closed = name(f"regexp_extract(p, {q(H.NAME_PATTERN)}, 1)", 2)
    bare = name(f"regexp_extract(p, {q(H.BARE_PATTERN)}, 1)", 1)
    decoded = f"CASE WHEN p[1] = '#' THEN coalesce({decimal}, {hexadecimal}) ELSE coalesce({closed}, {bare}) END"
    pieces = f"string_split({x}, '&')"
    piece = f"coalesce({decoded}, '&' || p)"
    out = f"{pieces}[1] || array_to_string(list_transform({pieces}[2:], lambda p: {piece}), '')"
    return f"CASE WHEN contains({x}, '&') THEN {out} ELSE {x} END"


def rounded(x: str, as_: str) -> str:
    return f"round(({x})::DOUBLE, {C.ROUND}) AS {as_}"


# --- pages -------------------------------------------------------------------------


def _blocks_cte() -> str:
    drop = f"regexp_replace(html, {pattern(H.DROP_PATTERN)}, ' \\1', 'g')"
    marked = f"regexp_replace({drop}, {q(BLOCK)}, chr(1) || '\\1', 'g')"
    anchors = (
        f"list_transform(regexp_split_to_array(b, {q(H.ANCHOR_START)})[2:], "
        f"lambda p: '<a' || regexp_replace(p, {q(H.ANCHOR_REST)}, ''))"
    )
    linked = words(drop_tags(f"array_to_string({anchors}, ' ')", " "))
    return f"""
      block AS (
        SELECT page_id, unnest(bs) AS b, generate_subscripts(bs, 1) AS pos
        FROM (SELECT page_id, string_split({marked}, chr(1)) AS bs FROM pages)),
      kept AS (
        SELECT page_id, pos, {collapse(drop_tags('b', ' '))} AS text, {linked} AS linked, b
        FROM block),
      joined AS (
        SELECT page_id, coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (
          {words('text')} > 0 AND linked * 3 <= {words('text')}
          AND ({words('text')} >= {H.MIN_BLOCK_WORDS}
               OR regexp_matches(b, {q(H.CONTENT_PATTERN)}))
          AND NOT regexp_matches(b, {q(NOISE)})), '') AS x
        FROM kept GROUP BY page_id),
      article AS (
        SELECT page_id,
          regexp_replace({unescape('x')}, {q('[ ' + chr(92) + 'x{A0}]+')}, ' ', 'g') AS text
        FROM joined)"""


def _heading_cte() -> str:
    raw = f"regexp_replace(html, {pattern(H.RAW_PATTERN)}, '\\1', 'g')"
    return f"""
      captured AS (
        SELECT page_id,
          {drop_tags(f"regexp_extract({raw}, {q(HEADING)}, 1)", '')} AS x FROM pages),
      heading AS (SELECT page_id, {unescape('x')} AS h1 FROM captured)"""


def _detected(text: str) -> str:
    toks = f"regexp_split_to_array(lower({text}), {q(L.NON_LETTERS)})"
    votes = [
        f"len(list_filter({toks}, lambda w: w IN {in_list(ws)}))" for ws in L.STOP_WORDS.values()
    ]
    return "[" + ", ".join(votes) + "]"


def _winner(votes: str) -> str:
    codes = "[" + ", ".join(q(c) for c in L.STOP_WORDS) + "]"
    return (
        f"CASE WHEN list_max({votes}) > 0 "
        f"THEN {codes}[list_position({votes}, list_max({votes}))] ELSE {q(L.UNDETERMINED)} END"
    )


def _french_cte() -> str:
    return f"""{_blocks_cte()}, {_heading_cte()},
      voted AS (SELECT page_id, text, {_detected('text')} AS votes FROM article WHERE text <> ''),
      french AS (
        SELECT p.page_id, p.url, h.h1, v.text
        FROM voted v JOIN pages p USING (page_id) JOIN heading h USING (page_id)
        WHERE {_winner('v.votes')} = 'fr')"""


def _docs_lang_cte() -> str:
    return f"""
      voted AS (SELECT *, {_detected('text')} AS votes FROM documents),
      detected AS (SELECT *, {_winner('votes')} AS detected FROM voted)"""


def _ngram_sql() -> str:
    word = f"list_filter(regexp_split_to_array(lower(text), {q(L.NON_LETTERS)}), lambda w: w <> '')"
    floor = f"round(ln({N.FLOOR_PROBABILITY}) * {N.WEIGHT_SCALE})::BIGINT"
    langs = N.LANGUAGES
    weights = ", ".join(
        f"coalesce(max(weight) FILTER (lang = {q(c)}), {floor}) AS w_{c}" for c in langs
    )
    sums = ", ".join(f"coalesce(sum(w_{c}), 0) AS s_{c}" for c in langs)
    best = "greatest(" + ", ".join(f"s_{c}" for c in langs) + ")"
    cases = " ".join(f"WHEN s_{c} = {best} THEN {q(c)}" for c in langs)
    return f"""
      WITH word AS (
        SELECT doc_id, lang, ' ' || unnest({word}) || ' ' AS w FROM documents),
      gram AS (
        SELECT doc_id, lang, unnest(list_transform(
          range(1, greatest(length(w) - {N.GRAM - 1}, 1) + 1),
          lambda i: substr(w, i, {N.GRAM}))) AS g
        FROM word),
      counted AS (
        SELECT lang, g, count(*) AS n FROM gram WHERE lang IN {in_list(langs)} GROUP BY lang, g),
      weighted AS (
        SELECT lang, g, greatest(
          round(ln(n / sum(n) OVER (PARTITION BY lang)) * {N.WEIGHT_SCALE})::BIGINT, {floor}
        ) AS weight
        FROM counted),
      profile AS (SELECT g, {weights} FROM weighted GROUP BY g),
      scored AS (
        SELECT d.doc_id, count(p.g) AS n_matched, {sums}
        FROM documents d LEFT JOIN gram USING (doc_id) LEFT JOIN profile p ON p.g = gram.g
        GROUP BY d.doc_id)
      SELECT doc_id, CASE WHEN n_matched = 0 THEN {q(L.UNDETERMINED)} {cases} END AS detected,
        n_matched
      FROM scored"""


def _language_model_sql() -> str:
    langs = N.LANGUAGES
    counts = ", ".join(f"count(*) FILTER (lang = {q(c)} AND doc_id % 5 <> 0) AS n_{c}" for c in langs)
    weights = ", ".join(
        f"round(ln((n_{c} + 1) / (t_{c} + {M.BINS})) * {N.WEIGHT_SCALE})::BIGINT AS w_{c}" for c in langs
    )
    known = " OR ".join(f"(n_{c} > 0 AND n_{c} >= {M.KNOWN} * t_{c})" for c in langs)
    sums = ", ".join(f"coalesce(sum(w_{c}), 0) AS s_{c}" for c in langs)
    all_ = ", ".join(f"sum(n_{c}) OVER () AS t_{c}" for c in langs)
    totals = "[" + ", ".join(f"s_{c}" for c in langs) + "]"
    step = f"least(margin // {M.MARGIN_STEP}, {M.STEPS})"
    return f"""
      WITH letters AS (
        SELECT doc_id, lang, trim(regexp_replace(lower(coalesce(text, '')), {q(L.NON_LETTERS)}, ' ', 'g'), ' ') AS t
        FROM documents),
      chars AS (
        SELECT doc_id, lang, unnest(c) AS c, generate_subscripts(c, 1) AS i
        FROM (SELECT doc_id, lang, string_split(' ' || t || ' ', '') AS c FROM letters WHERE t <> '')),
      run AS (
        SELECT doc_id, lang, unicode(c)::BIGINT AS a, lead(unicode(c)) OVER o AS b, lead(unicode(c), 2) OVER o AS c
        FROM chars WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
      gram AS (
        SELECT doc_id, lang, ((a * {M.FACTOR} + b) * {M.FACTOR} + c) % {M.BINS} AS bin FROM run WHERE c IS NOT NULL),
      counted AS (SELECT bin, {counts} FROM gram GROUP BY bin),
      weight AS (SELECT bin, {weights} FROM (SELECT *, {all_} FROM counted) WHERE {known}),
      total AS (
        SELECT doc_id, count(*) AS n, count(weight.bin) AS n_known, {sums}
        FROM gram LEFT JOIN weight USING (bin) GROUP BY doc_id),
      ranked AS (
        SELECT doc_id, n, n_known, {totals} AS s, list_reverse_sort({totals}) AS r FROM total),
      scored AS (
        SELECT d.doc_id, d.lang, CASE WHEN n_known > 0 AND 2 * n_known >= n THEN {in_list_of(langs)}[list_position(s, r[1])] END AS best,
          coalesce((r[1] - r[2]) // n, 0)::BIGINT AS margin, coalesce(n_known, 0) AS n_known
        FROM documents d LEFT JOIN ranked USING (doc_id)),
      step AS (
        SELECT {step} AS step, count(*) AS n, count(*) FILTER (best = lang) AS good
        FROM scored WHERE doc_id % 5 = 0 AND lang IN {in_list(langs)} AND best IS NOT NULL GROUP BY ALL),
      -- Every step, also one that no row has: the share from there on is that of the next.
      every AS (SELECT unnest(range(1, {M.STEPS} + 1)) AS step),
      share AS (
        SELECT every.step, coalesce(sum(n), 0) AS n, coalesce(sum(good), 0) AS good
        FROM every LEFT JOIN step ON step.step >= every.step GROUP BY every.step),
      least AS (
        SELECT coalesce(min(step) FILTER (good >= {M.PRECISION} * n), {M.STEPS}) * {M.MARGIN_STEP} AS margin FROM share)
      SELECT doc_id, CASE WHEN best IS NOT NULL AND scored.margin >= least.margin THEN best ELSE {q(L.UNDETERMINED)} END
        AS detected, scored.margin AS margin, n_known
      FROM scored, least"""


# --- segments ----------------------------------------------------------------------


def _sentences_cte() -> str:
    marked = f"regexp_replace(text, {q(S.SENTENCE_END)}, '\\1' || chr(1), 'g')"
    return f"""
      split AS (
        SELECT doc_id, list_filter(string_split({marked}, chr(1)),
          lambda s: regexp_matches(s, {q(T.NON_SPACE)})) AS ss
        FROM documents),
      sentence AS (
        SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM split),
      sized AS (SELECT *, {words('s')} AS k FROM sentence)"""


def _segments_cte() -> str:
    over = f"coalesce(list_sum(r.ks), 0) + s.k > {S.MAX_WORDS}"
    tail = f"[-{S.OVERLAP_SENTENCES}:]"
    return f"""{_sentences_cte()},
      last AS (SELECT doc_id, max(i) AS m FROM sized GROUP BY doc_id),
      packed(doc_id, i, cur, ks, closed) AS (
        SELECT doc_id, 0::BIGINT, []::VARCHAR[], []::BIGINT[], NULL::VARCHAR FROM last
        UNION ALL
        SELECT r.doc_id, r.i + 1,
          list_append(CASE WHEN {over} THEN r.cur{tail} ELSE r.cur END, s.s),
          list_append(CASE WHEN {over} THEN r.ks{tail} ELSE r.ks END, s.k),
          CASE WHEN {over} THEN array_to_string(r.cur, ' ') END
        FROM packed r JOIN sized s ON s.doc_id = r.doc_id AND s.i = r.i + 1),
      pieces AS (
        SELECT doc_id, i, 0 AS is_last, closed AS segment FROM packed WHERE closed IS NOT NULL
        UNION ALL
        SELECT p.doc_id, p.i, 1, array_to_string(p.cur, ' ')
        FROM packed p JOIN last l ON l.doc_id = p.doc_id AND l.m = p.i),
      segment AS (
        SELECT doc_id, segment,
          (row_number() OVER (PARTITION BY doc_id ORDER BY i, is_last) - 1)::INTEGER AS seg_no
        FROM pieces)"""


def _cells_cte() -> str:
    h = "('0x' || substr(md5(token), 1, 9))::BIGINT"
    return f"""{_segments_cte()},
      token AS (SELECT doc_id, seg_no, unnest({tokens('segment')}) AS token FROM segment),
      hashed AS (SELECT doc_id, seg_no, {h} AS h FROM token),
      cell AS (
        SELECT doc_id, seg_no, (h >> 4) % {V.DIM} AS bucket, sum(1 - 2 * (h % 2)) AS value
        FROM hashed GROUP BY ALL HAVING sum(1 - 2 * (h % 2)) <> 0),
      unit AS (
        SELECT doc_id, seg_no, bucket, value::DOUBLE / sqrt(
          sum(value::DOUBLE * value::DOUBLE) OVER (PARTITION BY doc_id, seg_no)) AS weight
        FROM cell)"""


def _embeddings_cte() -> str:
    return f"""{_cells_cte()},
      n AS (SELECT doc_id, count(*) AS n_segments FROM segment GROUP BY doc_id),
      pooled AS (
        SELECT doc_id, bucket, sum(weight) / any_value(n_segments) AS m
        FROM unit JOIN n USING (doc_id) GROUP BY doc_id, bucket),
      embedded AS (
        SELECT doc_id, bucket AS pos, (m / greatest(
          sqrt(sum(m * m) OVER (PARTITION BY doc_id)), 1e-12))::FLOAT AS m
        FROM pooled)"""


def _search_sql() -> str:
    h = "('0x' || substr(md5(token), 1, 9))::BIGINT"
    asked = ", ".join(
        f"({q(name)}, {q(t)})" for name, text in C.FULL_TEXT.items() for t in text.split()
    )
    return f"""
      WITH RECURSIVE {_embeddings_cte()},
      asked(query_id, token) AS (VALUES {asked}),
      asked_cell AS (
        SELECT query_id, (({h}) >> 4) % {V.DIM} AS pos, sum(1 - 2 * (({h}) % 2)) AS w
        FROM asked GROUP BY ALL),
      asked_unit AS (
        SELECT query_id, pos, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w
        FROM asked_cell),
      met AS (
        SELECT query_id, doc_id, sum(m::DOUBLE * w) AS s
        FROM embedded JOIN asked_unit USING (pos) GROUP BY query_id, doc_id),
      scored AS (
        SELECT query_id, n.doc_id, round(coalesce(s, 0.0), {K.SCORE_DECIMALS}) AS s
        FROM (SELECT DISTINCT query_id FROM asked) CROSS JOIN n
        LEFT JOIN met USING (query_id, doc_id)),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank
        FROM scored)
      SELECT query_id, doc_id, {rounded('s', 'score')}, rank FROM ranked WHERE rank <= {C.K}"""


def _pooled_cte() -> str:
    return """
      element AS (
        SELECT label, generate_subscripts(embedding, 1) - 1 AS pos,
          unnest(embedding)::DOUBLE AS x FROM embeddings),
      mean AS (SELECT label, pos, avg(x) AS m FROM element GROUP BY label, pos),
      centre AS (
        SELECT label, pos, m / greatest(sqrt(sum(m * m) OVER (PARTITION BY label)), 1e-12) AS m
        FROM mean)"""


def _knn_sql(condition: str) -> str:
    return f"""
      WITH {_pooled_cte()},
      query AS (SELECT label AS query_id, list(m ORDER BY pos) AS v FROM centre GROUP BY label),
      scored AS (
        SELECT query_id, vec_id,
          round(list_inner_product(embedding::DOUBLE[], v), {K.SCORE_DECIMALS}) AS s
        FROM embeddings, query WHERE {condition}),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank
        FROM scored)
      SELECT query_id, vec_id, {rounded('s', 'score')}, rank FROM ranked WHERE rank <= {C.K}"""


# --- full text ---------------------------------------------------------------------


def _bm25_sql(source: str = "", key: str = "page_id", text: str = "h1") -> str:
    source = source or f"{_heading_cte()}, asked_of AS (SELECT page_id, h1 FROM heading)"
    asked = ", ".join(
        f"({q(name)}, {q(t)})" for name, text in C.FULL_TEXT.items() for t in text.split()
    )
    return f"""
      WITH {source},
      analysed AS (SELECT {key}, {tokens(text)} AS terms FROM asked_of),
      stats AS (SELECT count(*) AS n, avg(len(terms)) AS avg_len FROM analysed),
      posting AS (
        SELECT {key}, len(terms) AS dl, term, count(*) AS tf
        FROM (SELECT {key}, terms, unnest(terms) AS term FROM analysed)
        GROUP BY {key}, dl, term),
      frequency AS (SELECT term, count(*) AS df FROM posting GROUP BY term),
      asked(query_id, term) AS (VALUES {asked}),
      scored AS (
        SELECT query_id, {key}, round(sum(
          ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {Q.K1 + 1}
          / (tf + {Q.K1} * ({1 - Q.B} + {Q.B} * dl / avg_len))), {K.SCORE_DECIMALS}) AS s
        FROM asked JOIN posting USING (term) JOIN frequency USING (term), stats
        GROUP BY query_id, {key}),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, {key}) AS rank
        FROM scored)
      SELECT query_id, {key}, {rounded('s', 'score')}, rank FROM ranked WHERE rank <= {C.K}"""


def _routing_sql() -> str:
    step = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.EVENT_STEPS.items())
    return f"""
      WITH message AS (
        SELECT CASE event_type {step} END AS step, user_id, event_id, user_id % 2 = 0 AS broken
        FROM events),
      routed AS (
        SELECT CASE WHEN broken THEN NULL WHEN step = 'warc' THEN 'warc_logs'
            WHEN step = 'vector' THEN 'vector_logs'
            WHEN step IN ('index', 'index_batch_async') THEN 'index_logs' END AS collection,
          CASE WHEN broken THEN 'corrupt' WHEN step = 'other' THEN 'unknown step' END AS error,
          CASE WHEN NOT broken THEN user_id END AS computer,
          CASE WHEN NOT broken THEN event_id END AS batchsize
        FROM message)
      SELECT collection, error, count(*) AS n, count(DISTINCT computer) AS n_computers,
        coalesce(sum(batchsize), 0)::BIGINT AS sum_batchsize
      FROM routed GROUP BY collection, error"""


def _batches_sql() -> str:
    h = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT"
    return f"""
      WITH bucketed AS (
        SELECT doc_id, {h} % (SELECT greatest(ceil(count(*) / {C.ROWS_PER_BUCKET}.0), 1)::BIGINT
          FROM documents) AS bucket FROM documents),
      placed AS (
        SELECT doc_id, row_number() OVER (ORDER BY bucket, doc_id) - 1 AS pos FROM bucketed)
      SELECT (pos // {C.BATCH})::BIGINT AS batch, count(*) AS n_docs, min(doc_id) AS first_doc,
        max(doc_id) AS last_doc
      FROM placed GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    props_k = "(props->>'$.k')::BIGINT"
    return {
        "pages_scan": "SELECT page_id, url, html FROM pages",
        "resolve_paths": f"""
          SELECT page_id, {q(T.ARCHIVE_HOST)} || url AS path, md5(url) AS local_key FROM pages""",
        "extract_text": f"""
          WITH visible AS (
            SELECT page_id, {drop_tags(
                f"regexp_replace(html, {pattern(H.DROP_PATTERN)}, ' \\1', 'g')", ' ')} AS x FROM pages),
          plain AS (SELECT page_id, {unescape('x')} AS x FROM visible)
          SELECT page_id, {collapse('x')} AS text FROM plain""",
        "extract_blocks": f"WITH {_blocks_cte()} SELECT page_id, text FROM article",
        "site_blocks": f"""
          WITH {_blocks_cte()},
          sited AS (
            SELECT page_id, string_split(a.text, chr(10)) AS lines,
              lower(regexp_extract(p.url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host
            FROM article a JOIN pages p USING (page_id)),
          line AS (
            SELECT page_id, host, unnest(lines) AS b, generate_subscripts(lines, 1) AS pos FROM sited),
          size AS (SELECT host, count(*) AS size FROM sited GROUP BY 1),
          template AS (
            SELECT host, b FROM line JOIN size USING (host) WHERE b <> '' GROUP BY host, b, size
            HAVING count(DISTINCT page_id) >= {P.MIN_PAGES}
              AND count(DISTINCT page_id) >= {P.SHARE} * size)
          SELECT page_id, coalesce(string_agg(l.b, chr(10) ORDER BY pos) FILTER (t.b IS NULL), '') AS text,
            count(t.b) AS n_dropped
          FROM line l LEFT JOIN template t ON l.host = t.host AND l.b = t.b GROUP BY 1""",
        "first_h1": f"WITH {_heading_cte()} SELECT page_id, h1 FROM heading",
        "french_pages": f"WITH {_french_cte()} SELECT page_id, url, h1, text FROM french",
        "encode_messages": f"""
          WITH {_french_cte()}
          SELECT to_json({{'url': url, 'h1': h1, 'text': text}})::VARCHAR AS value FROM french""",
        "detect_lang": f"WITH {_docs_lang_cte()} SELECT doc_id, detected FROM detected",
        "detect_lang_ngram": _ngram_sql(),
        "detect_lang_model": _language_model_sql(),
        "french_documents": f"""
          WITH {_docs_lang_cte()}
          SELECT doc_id, source, n_chars, detected FROM detected WHERE detected = 'fr'""",
        "corpus_profile": f"""
          WITH RECURSIVE {_docs_lang_cte()}, {_segments_cte()},
          n AS (SELECT doc_id, count(*) AS n_segments FROM segment GROUP BY doc_id)
          SELECT coalesce(detected, 'total') AS detected, count(*) AS n_docs,
            count(*) FILTER (detected = 'fr') AS n_kept,
            count(*) - count(*) FILTER (detected = 'fr') AS n_dropped,
            sum(coalesce(n_segments, 0))::BIGINT AS n_segments
          FROM detected LEFT JOIN n USING (doc_id) GROUP BY ROLLUP (detected)""",
        "sentence_split": f"""
          WITH {_sentences_cte()}
          SELECT doc_id, (i - 1)::INTEGER AS sent_no, s AS sentence FROM sentence""",
        "word_count": f"SELECT doc_id, ({words('text')})::INTEGER AS n_words FROM documents",
        "segment_text": f"""
          WITH RECURSIVE {_segments_cte()}
          SELECT d.doc_id, coalesce(string_agg(segment, chr(10) || '--' || chr(10)
            ORDER BY seg_no), '') AS segments
          FROM documents d LEFT JOIN segment USING (doc_id) GROUP BY d.doc_id""",
        "segments_exploded": f"""
          WITH RECURSIVE {_segments_cte()} SELECT doc_id, seg_no, segment FROM segment""",
        "segment_counts": f"""
          WITH RECURSIVE {_segments_cte()}
          SELECT d.doc_id, count(seg_no)::INTEGER AS n_segments
          FROM documents d LEFT JOIN segment USING (doc_id) GROUP BY d.doc_id""",
        "hash_encode": f"""
          WITH RECURSIVE {_cells_cte()}
          SELECT doc_id, seg_no, bucket::INTEGER AS bucket, {rounded('weight', 'weight')}
          FROM unit""",
        "encode_udf": f"""
          WITH RECURSIVE {_cells_cte()}
          SELECT doc_id, seg_no, bucket, {rounded('weight::FLOAT', 'weight')} FROM unit""",
        "mean_pool": f"""
          WITH {_pooled_cte()},
          out AS (SELECT label, pos, {rounded('m', 'value')} FROM mean)
          SELECT * FROM out WHERE value <> 0""",
        "doc_embedding": f"""
          WITH {_pooled_cte()},
          out AS (SELECT label, pos, {rounded('m', 'value')} FROM centre)
          SELECT * FROM out WHERE value <> 0""",
        "embed_documents": f"""
          WITH RECURSIVE {_embeddings_cte()},
          out AS (SELECT doc_id, pos, {rounded('m', 'value')} FROM embedded)
          SELECT * FROM out WHERE value <> 0""",
        "search_documents": _search_sql(),
        "dim_check": "SELECT vec_id, len(embedding) = 64 AS dim_ok FROM embeddings",
        "index_batches": _batches_sql(),
        "knn_exact": _knn_sql("true"),
        "knn_filtered": _knn_sql("label = query_id"),
        "knn_single": f"""
          WITH query AS (SELECT arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings),
          scored AS (
            SELECT vec_id,
              round(list_inner_product(embedding::DOUBLE[], v), {K.SCORE_DECIMALS}) AS s
            FROM embeddings, query)
          SELECT vec_id, {rounded('s', 'score')} FROM scored ORDER BY s DESC, vec_id
          LIMIT {C.K}""",
        "url_lookup": f"""
          WITH {_french_cte()}
          SELECT p.page_id, p.url, h.h1 FROM pages p JOIN heading h USING (page_id)
          WHERE p.url IN (SELECT url FROM french)""",
        "h1_postings": f"""
          WITH {_heading_cte()},
          analysed AS (SELECT page_id, {tokens('h1')} AS terms FROM heading)
          SELECT term, page_id, count(*) AS tf, doc_len
          FROM (SELECT page_id, len(terms) AS doc_len, unnest(terms) AS term FROM analysed)
          GROUP BY term, page_id, doc_len""",
        "h1_bm25": _bm25_sql(),
        "h1_bm25_stored": _bm25_sql(),
        "text_bm25_stored": _bm25_sql("asked_of AS (SELECT doc_id, text FROM documents)", "doc_id", "text"),
        "parse_props": f"SELECT event_id, {props_k} AS k FROM events",
        "metric_total": f"""
          SELECT event_id, {rounded(
              f'value + {props_k} + 0.25 + user_id * 0.5', 'total_time')} FROM events""",
        "metric_routing": _routing_sql(),
        "running_total": f"""
          SELECT event_id, user_id, {rounded(
              'sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id'
              ' ROWS UNBOUNDED PRECEDING)', 'running_total')} FROM events""",
        "metrics_rollup": f"""
          SELECT date_trunc('hour', ts) AS bucket_start, event_type, count(*) AS n,
            round(avg(value), 9) AS mean, max(value) AS max, quantile_disc(value, 0.5) AS median
          FROM events GROUP BY ALL""",
        # A day's values of a type are fewer than a sketch holds, so that its quantiles are exact.
        "metrics_quantiles": """
          SELECT date_trunc('day', ts)::TIMESTAMP AS bucket_start, event_type, count(value) AS n,
            quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.99) AS p99
          FROM events GROUP BY ALL""",
    }
