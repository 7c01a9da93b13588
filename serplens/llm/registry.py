"""Queries of this subpackage by name, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serplens.llm import (
    op01_substring_dedup,
    op02_disclosure,
    op03_jaccard_join,
    op04_secret_scan,
    op05_token_blocks,
    op06_ppm,
    op07_decontamination,
    op08_site_spread,
    op09_line_labels,
)
from serplens.llm import op10_mixing as mixing
from serplens.llm import op11_spot_signatures as spots
from serplens.llm import op12_fill_in_middle as middle
from serplens.llm import op13_ranked_search as search
from serplens.llm.tables import documents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op3_jaccard_join(spark, sf_dir):
    """Every document with its component of texts that share three quarters of their shingles."""
    return op03_jaccard_join.jaccard_classes(documents(spark, sf_dir))


@query
def op5_token_blocks(spark, sf_dir):
    """Every document as its encoded files give it back."""
    return op05_token_blocks.encoded_roundtrip(documents(spark, sf_dir), tokenizer_file())


@query
def op10_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    sized = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_mixing"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source
), rounds AS (
  SELECT 0 AS n, source, s, w, false AS capped FROM sources
  UNION ALL
  SELECT n + 1, source, s, w, capped OR 3 * s * sum(CASE WHEN capped THEN 0 ELSE w END) OVER ()
      < (sum(s) OVER () - sum(CASE WHEN capped THEN 3 * s ELSE 0 END) OVER ()) * w
  FROM rounds WHERE n < (SELECT count(*) FROM sources)
), targets AS (
  SELECT source, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE) ELSE
      CAST((sum(s) OVER () - sum(CASE WHEN capped THEN 3 * s ELSE 0 END) OVER ()) * w AS DOUBLE)
      / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END AS target
  FROM rounds WHERE n = (SELECT count(*) FROM sources)
), placed AS (
  SELECT d.doc_id, d.size, t.s, t.target,
         CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, s AS source_size, target,
       CAST(budget // greatest(s, 1) * size
            + greatest(0, least(size, budget % greatest(s, 1) - before)) AS BIGINT) AS taken
FROM placed
"""


@query
def op7_decontamination(spark, sf_dir):
    """Words of every document that lie in a window of a benchmark item."""
    return op07_decontamination.with_item_digest(
        op07_decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")))


_WORDS7 = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLES["op7_decontamination"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS7}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS7} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query
def op4_secret_scan(spark, sf_dir):
    """Secrets of every document: known forms and strings that pass for random."""
    return op04_secret_scan.with_span_digest(op04_secret_scan.scan(documents(spark, sf_dir)))


@query
def op9_line_labels(spark, sf_dir):
    """Word and line counts of every document and whether its lines are content."""
    docs = documents(spark, sf_dir)
    field = op09_line_labels.fit_field(docs, table(spark, sf_dir, "labels"))
    return op09_line_labels.quality(docs.select("doc_id", "text"), field).drop("text")


@query
def op6_ppm(spark, sf_dir):
    """Log10 probability of every document under a word count model and a byte context model."""
    return op06_ppm.ppm_scores(documents(spark, sf_dir))


@query
def op2_disclosure(spark, sf_dir):
    """Personal data of every document and the terms that disclose it."""
    return op02_disclosure.sanitised_scan(documents(spark, sf_dir))


@query
def op1_substring_dedup(spark, sf_dir):
    """Every document without passages that stand in an earlier one, and where they stood."""
    return op01_substring_dedup.dedup(documents(spark, sf_dir))


@query
def op8_site_spread(spark, sf_dir):
    """Every document without the lines that occur in many sources."""
    return op08_site_spread.remove_boilerplate(documents(spark, sf_dir))


@query
def op11_spot_signatures(spark, sf_dir):
    """Fingerprint of every document, next to that of an edited copy and of the next document."""
    return spots.with_digest(spots.compared_with_edits(documents(spark, sf_dir)))


_WORDS11 = f"regexp_extract_all(translate(text, '{spots.UPPER}', '{spots.LOWER}'), '{spots.WORD}')"
#: Signatures of the texts in d(side, doc_id, text): of side 0 the documents, of side 1 their edited texts.
_PRINTS11 = f"""
tok AS (SELECT side, doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word
  FROM (SELECT side, doc_id, {_WORDS11} AS w FROM d)),
flagged AS (SELECT tok.*, a.word IS NOT NULL AS anchor FROM tok LEFT JOIN anchors a USING (word)),
numbered AS (SELECT *, count(*) FILTER (NOT anchor) OVER (PARTITION BY side, doc_id ORDER BY i) AS c FROM flagged),
content AS (SELECT side, doc_id, c, word FROM numbered WHERE NOT anchor),
spots AS (SELECT side, doc_id, c + 1 AS c, word FROM numbered WHERE anchor
  UNION ALL SELECT DISTINCT side, doc_id, 1, '' FROM d),
chains AS (SELECT DISTINCT s.side, s.doc_id, left(md5(concat_ws(' ', s.word, x.word, y.word, z.word)), {spots.DIGITS}) AS h
  FROM spots s JOIN content x ON (x.side, x.doc_id, x.c) = (s.side, s.doc_id, s.c)
  LEFT JOIN content y ON (y.side, y.doc_id, y.c) = (s.side, s.doc_id, s.c + 1)
  LEFT JOIN content z ON (z.side, z.doc_id, z.c) = (s.side, s.doc_id, s.c + 2)),
prints AS (SELECT side, doc_id, list(h ORDER BY h) AS p FROM chains GROUP BY side, doc_id)"""
_LIKE11 = """CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE
  ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"""
ORACLES["op11_spot_signatures"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n,
  coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), first(doc_id) OVER (ORDER BY doc_id DESC)) AS next_id,
  coalesce(lead(text) OVER (ORDER BY doc_id DESC), first(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM t),
d AS (SELECT 0 AS side, doc_id, text FROM t
  UNION ALL SELECT 1, doc_id, left(text, n - n // 2) || left(next_text, n // 2) FROM n),
df AS (SELECT word, count(DISTINCT doc_id) AS f FROM (SELECT doc_id, unnest({_WORDS11}) AS word FROM t)
  WHERE length(word) <= {spots.ANCHOR_CHARS} GROUP BY word),
anchors AS (SELECT word FROM (SELECT word, row_number() OVER (ORDER BY f DESC, word) AS r, count(*) OVER () AS k FROM df)
  WHERE r <= least({spots.ANCHORS}, k // {spots.ANCHOR_SHARE})),
{_PRINTS11},
three AS (SELECT n.doc_id, n.n, e.text AS edited, coalesce(o.p, []) AS p, coalesce(c.p, []) AS q, coalesce(x.p, []) AS r
  FROM n JOIN d e ON e.side = 1 AND e.doc_id = n.doc_id LEFT JOIN prints o ON o.side = 0 AND o.doc_id = n.doc_id
  LEFT JOIN prints c ON c.side = 1 AND c.doc_id = n.doc_id LEFT JOIN prints x ON x.side = 0 AND x.doc_id = n.next_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(p, ',') AS fingerprint,
  array_to_string(q, ',') AS edited_fingerprint, {_LIKE11.format(a='p', b='q')} AS near_edited,
  {_LIKE11.format(a='p', b='r')} AS near_next FROM three
"""


@query
def op12_fill_in_middle(spark, sf_dir):
    """Every document cut at line ends into prefix, middle and suffix, rearranged, and rebuilt from that."""
    return middle.with_digests(middle.fill_in_middle(documents(spark, sf_dir)))


ORACLES["op12_fill_in_middle"] = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS w,
  CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS pre, coalesce(array_to_string(w[a + 1:b], ''), '') AS mid,
  coalesce(array_to_string(w[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query
def op13_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return search.ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_TERMS13 = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""
ORACLES["op13_ranked_search"] = f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS13} FROM documents) GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, docs),
impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)) AS impact
  FROM tf JOIN lengths USING (doc_id), totals),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS13} FROM benchmark)),
scores AS (SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT * FROM (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score FROM scores WHERE score > 0) WHERE rank <= 50
"""
