"""Lines of recurring templates, found by a tree of fixed depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.session import stage

#: Leading tokens that are levels of the tree, below the level of the token count.
DEPTH = 3
#: Documents in which a template must occur to recur, and in which a line of ``LONG_TOKENS`` must occur unchanged.
MIN_DOCS, LONG_DOCS, LONG_TOKENS = 4, 2, 40
#: Share of a leaf's documents that have a constant token, and share of constants behind the leading tokens.
LEAF_SHARE, CONSTANT_SHARE = 0.3, 0.6
#: Runs of white space other than a single blank.
_SPACES = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"
_SOLID = r"[^\x20\x09\x0B-\x0D]"
_VARIABLE = r"[^ ]*[0-9][^ ]*"
WILDCARD = "<*>"


def _tokens(line: Column) -> Column:
    """Tokens apart by one blank; those with a digit are variable fields."""
    apart = F.trim(F.regexp_replace(line, _SPACES, " "))
    return F.when(apart.rlike("[0-9]"), F.regexp_replace(apart, _VARIABLE, WILDCARD)).otherwise(apart)


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                    constant_share: float = CONSTANT_SHARE, leaf_share: float = LEAF_SHARE, long_tokens: int = LONG_TOKENS,
                    long_docs: int = LONG_DOCS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Lines to drop: ``doc_id``, ``text_hash``, ``line_no`` and a hash of the template of each.

    A line's token count and its first ``depth`` tokens lead to a leaf. In a leaf, a token that at least
    ``leaf_share`` of its documents, and ``min_docs``, have at its position is constant; others, and
    tokens with a digit anywhere, are variable fields. As a leaf grows, so does what a constant needs,
    so values of a field stay variable. The line's template is its constant tokens with ``<*>`` for the
    fields. A template recurs if at least ``min_docs`` documents have it and at least ``constant_share`` of
    its tokens behind the leading ones are constant. A line whose tokens ``min_docs`` documents have as they are is a
    template of its own, however small their share of the leaf; so is a line of ``long_tokens`` in
    ``long_docs`` documents. All lines of a template are dropped but the first: the one of the
    smallest (identifier, text hash, line).

    Identical lines are counted together before anything is joined, so a line that a
    third of all documents have is one row there. Lines in leaves of fewer documents
    than can recur go no further. What remains is written once. Lines and
    templates are told apart by 128 bits, leaves by 64.

    Rows with the same identifier and text count as one document. A null text or blank line
    has no tokens and is never dropped; null identifiers are last in the order. An empty table has no such lines.
    """
    # The hash comes before the lines are spread, and the test for blank lines reads the raw line,
    # so that whole texts and rewritten lines are not worked on again for each line.
    texts = docs.select(quoted(id_column).alias("doc_id"), F.xxhash64(quoted(text_column)).alias("text_hash"),
                        F.split(quoted(text_column), "\n").alias("lines"))
    rows = texts.select("doc_id", "text_hash", F.posexplode("lines").alias("line_no", "line")).filter(
        F.col("line").rlike(_SOLID)).select("doc_id", "text_hash", "line_no", _tokens(F.col("line")).alias("tokens"))
    length = F.length("tokens") - F.length(F.replace("tokens", F.lit(" "), F.lit(""))) + 1
    lines = rows.withColumn("n", length).withColumn("leaf", F.xxhash64("n", F.substring_index("tokens", " ", depth)))

    def enough(count: str) -> Column:
        return (F.col(count) >= min_docs) | ((F.col(count) >= long_docs) & (F.col("n") >= long_tokens))

    leaves = lines.select("leaf", "n", "doc_id", "text_hash").distinct().groupBy("leaf", "n").agg(
        F.count(F.lit(1)).alias("leaf_docs")).filter(enough("leaf_docs")).drop("n")
    held = stage(lines.join(leaves, "leaf").select(
        "*", F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2")), "lines")

    line = ["leaf", "leaf_docs", "n", "h1", "h2"]
    documents = held.select(*line, "doc_id", "text_hash").distinct().groupBy(*line).agg(F.count(F.lit(1)).alias("docs"))
    alike = documents.filter(enough("docs")).select("h1", "h2", F.col("h1").alias("t1"), F.xxhash64("h2").alias("t2"))
    fields = held.filter((F.col("leaf_docs") >= min_docs) & (F.col("n") > depth))
    different = fields.select(*line, "tokens").distinct().join(documents, line)
    spread = different.select(*line, "docs", F.posexplode(F.slice(F.split("tokens", " "), depth + 1, F.col("n"))).alias(
        "at", "token")).filter(F.col("token") != WILDCARD)
    constants = spread.groupBy("leaf", "leaf_docs", "at", "token").agg(F.sum("docs").alias("support")).filter(
        (F.col("support") >= min_docs) & (F.col("support") >= leaf_share * F.col("leaf_docs"))).select("leaf", "at", "token")
    general = spread.join(constants, ["leaf", "at", "token"]).groupBy(*line).agg(
        F.sort_array(F.collect_list(F.struct("at", "token"))).alias("constant")).filter(
        F.size("constant") >= constant_share * (F.col("n") - depth)).select(
        "h1", "h2", F.xxhash64("leaf", "constant").alias("t1"), F.xxhash64("constant", "leaf").alias("t2"))
    matched = stage(held.select("doc_id", "text_hash", "line_no", "n", "h1", "h2").join(general.union(alike), ["h1", "h2"]).drop(
        "h1", "h2"), "templates")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "line_no")
    first = matched.groupBy("t1", "t2", "n", "doc_id", "text_hash").agg(F.min("line_no").alias("line_no")).groupBy(
        "t1", "t2", "n").agg(F.count(F.lit(1)).alias("docs"), F.min(order).alias("first")).filter(enough("docs")).drop("docs", "n")
    return matched.join(first, ["t1", "t2"]).filter(~order.eqNullSafe(F.col("first"))).groupBy(
        "doc_id", "text_hash", "line_no").agg(F.min("t1").alias("template_hash"))


def drop_recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS,
                         constant_share: float = CONSTANT_SHARE, leaf_share: float = LEAF_SHARE, long_tokens: int = LONG_TOKENS,
                         long_docs: int = LONG_DOCS, id_column: str = "doc_id", text_column: str = "text",
                         dropped_column: str = "dropped") -> DataFrame:
    """The input with the lines of ``recurring_lines`` taken out of its text, and their number as ``dropped_column``.

    Every row stays; a text all of whose lines go becomes empty, null stays null. Columns may have
    any names; one named as ``dropped_column`` is replaced.
    """
    found = recurring_lines(docs, depth, min_docs, constant_share, leaf_share, long_tokens, long_docs, id_column, text_column)
    gone = found.groupBy(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).agg(
        F.collect_set("line_no").alias("gone"))
    own = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"))
    text = F.col("row").getField(text_column)
    met = own.join(gone, F.col("row").getField(id_column).eqNullSafe(F.col("gone_id")) & (F.xxhash64(text) == F.col("gone_hash")), "left")
    # Lines with their number in front are texts that differ, so one set takes out those that go.
    every = F.split(text, "\n")
    numbered = F.transform(every, lambda x, i: F.concat(F.lpad(i.cast("string"), 10, "0"), x))
    dropped = F.transform("gone", lambda i: F.concat(F.lpad(i.cast("string"), 10, "0"), F.get(every, i)))
    kept = F.array_join(F.transform(F.array_except(numbered, dropped), lambda x: F.substring(x, 11, 2 ** 31 - 1)), "\n")
    return met.select(
        *[F.when(F.col("gone").isNull(), text).otherwise(kept).alias(c) if c == text_column else F.col("row").getField(c).alias(c)
          for c in docs.columns if c != dropped_column],
        F.coalesce(F.size("gone"), F.lit(0)).alias(dropped_column))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
m AS (
  SELECT doc_id, line, line_no, regexp_replace(trim(regexp_replace(line, '[\x20\x09\x0B-\x0D]+', ' ', 'g')),
         '[^ ]*[0-9][^ ]*', '<*>', 'g') AS tokens FROM l),
s AS (SELECT *, string_split(tokens, ' ') AS t FROM m WHERE tokens != ''),
k AS (SELECT *, len(t) AS n, array_to_string(t[1:3], ' ') AS lead FROM s),
h AS (SELECT n, lead, count(DISTINCT doc_id) AS leaf_docs FROM k GROUP BY ALL HAVING leaf_docs >= 4 OR (leaf_docs >= 2 AND n >= 40)),
held AS (SELECT k.*, leaf_docs FROM k JOIN h USING (n, lead)),
d AS (SELECT n, lead, tokens, any_value(t) AS t, any_value(leaf_docs) AS leaf_docs, count(DISTINCT doc_id) AS docs
      FROM held GROUP BY n, lead, tokens),
e AS (SELECT n, lead, tokens, docs, leaf_docs, unnest(t[4:]) AS token, unnest(range(3, len(t))) AS pos FROM d
      WHERE n > 3 AND leaf_docs >= 4),
u AS (SELECT n, lead, pos, token, sum(docs) AS support FROM e GROUP BY ALL),
f AS (SELECT n, lead, tokens, string_agg(CASE WHEN constant THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template,
             sum(CASE WHEN constant THEN 1 ELSE 0 END) AS constants
      FROM (SELECT e.*, token != '<*>' AND support >= 4 AND support >= 0.3::DOUBLE * leaf_docs AS constant
            FROM e JOIN u USING (n, lead, pos, token))
      GROUP BY n, lead, tokens HAVING constants >= 0.6::DOUBLE * (n - 3) AND constants > 0),
g AS (SELECT held.doc_id, line_no, n, 'general' AS kind, lead || ' ' || template AS template FROM held JOIN f USING (n, lead, tokens)
      UNION ALL SELECT held.doc_id, line_no, n, 'alike', tokens FROM held JOIN d USING (n, lead, tokens)
      WHERE docs >= 4 OR (docs >= 2 AND n >= 40)),
r AS (SELECT kind, template, min((doc_id, line_no)) AS first FROM g GROUP BY kind, template
      HAVING count(DISTINCT doc_id) >= 4 OR (count(DISTINCT doc_id) >= 2 AND any_value(n) >= 40)),
x AS (SELECT DISTINCT doc_id, line_no FROM g JOIN r USING (kind, template) WHERE (doc_id, line_no) != first),
y AS (SELECT l.doc_id, string_agg(CASE WHEN x.line_no IS NULL THEN line END, chr(10) ORDER BY l.line_no) AS text,
             count(x.line_no) AS dropped
      FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.line_no = x.line_no GROUP BY l.doc_id)
SELECT doc_id, coalesce(y.text, CASE WHEN documents.text IS NOT NULL THEN '' END) AS text, coalesce(dropped, 0) AS dropped
FROM documents LEFT JOIN y USING (doc_id)
"""
