from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.queries.registry import query, table
from skyweave.llm.spelling import spelling_variants, word_counts
from skyweave.llm.workspace import Workspace

_SQL = r"""
WITH RECURSIVE bits(i, c) AS (
  SELECT range, range FROM range(256)
), crc AS (
  SELECT list(list_reduce([c, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM bits
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), one AS (
  SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, times, xor(list_reduce(
    [CAST(4294967295 AS BIGINT)] || flatten(list_transform(
      string_split(concat(CAST(doc_id AS VARCHAR), ':', run), ''),
      lambda s: CASE WHEN unicode(s) < 128 THEN [CAST(unicode(s) AS BIGINT)]
        ELSE [CAST(192 + (unicode(s) >> 6) AS BIGINT), CAST(128 + (unicode(s) & 63) AS BIGINT)] END)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM one, crc
), changed AS (
  SELECT times, CASE WHEN h % 31 = 0
    THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), cut AS (
  SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT near.word, count(*) AS n_near, first(b.word ORDER BY b.n DESC, b.word) AS form, max(b.n) AS form_n
  FROM near JOIN words b ON b.word = near.near GROUP BY near.word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 10 * w.n THEN form END AS form, CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain(word, root) AS (
  SELECT word, word FROM judged
  UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.root WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word
WHERE c.root IN (SELECT word FROM judged WHERE form IS NULL)
"""


def _noisy(doc_id: Column, run: Column) -> Column:
    """In one of 31 cases a code point goes: made-up misspellings, the same in every run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


@query("op12_spelling_variants", _SQL)
def spelling_variants_of_words(spark: SparkSession, folder: str) -> DataFrame:
    words = word_counts(table(spark, folder, "documents"), change=_noisy)
    return spelling_variants(words, Workspace(spark, "spelling")).select("word", "form", "root", "n", "n_near", "form_n")
