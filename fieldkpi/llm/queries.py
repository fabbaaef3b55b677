"""The registered queries of this package and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkpi.llm import classifier, collocations, contamination, frames, language, mixing, neardup, passages, periodic, pieces, pseudo, rules, suffixes, urls

#: The file of the model that op13 encodes with.
MODEL = "piece_bpe_32k.model"

RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)
#: Hosts with such a label are listed: the cascade blocks them where no rule fits.
LISTED_LABELS = ("ads-track", "casino-win", "free-bets", "cheap-pills", "spam-farm", "adult-x")
LISTED = rf"(^|[.])({'|'.join(LISTED_LABELS)})[.]"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(frames.documents(spark, sf_dir), width=3, percent=85)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(frames.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "repeats")


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(frames.documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality(frames.documents(spark, sf_dir), frames.labels(spark, sf_dir))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(frames.documents(spark, sf_dir))


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(frames.documents(spark, sf_dir), frames.benchmark(spark, sf_dir))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(frames.documents(spark, sf_dir), frames.labels(spark, sf_dir))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.scored(frames.documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(frames.documents(spark, sf_dir))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, F.col("host").rlike(LISTED))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(frames.documents(spark, sf_dir), periodic.planted)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(frames.documents(spark, sf_dir)).drop("cut")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(frames.documents(spark, sf_dir), pieces.load(public_tokenizers.path(MODEL)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_mixing": op2_mixing,
    "op3_passages": op3_passages,
    "op4_quality": op4_quality,
    "op5_suffixes": op5_suffixes,
    "op6_contamination": op6_contamination,
    "op7_rules": op7_rules,
    "op8_pseudo_likelihood": op8_pseudo_likelihood,
    "op9_language": op9_language,
    "op10_urls": op10_urls,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_sentencepiece": op13_sentencepiece,
}


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this library on the path of a local session's Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames.importable(spark)
        return QUERIES[name](spark, sf_dir)

    return run


def _rule_cases(column: str) -> str:
    order = sorted(RULES, key=lambda r: (len(r.host) + len(r.path), r.host + r.path), reverse=True)
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND path LIKE '{r.path}%' THEN '{r.host + r.path if column == 'rule' else r.verdict}'" for r in order
    )
    return f"CASE {cases} END"


def _phrases(k: int) -> str:
    return f"""SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, COUNT(*) AS f
               FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces) GROUP BY ALL"""


ORACLES: dict[str, str] = {
    "op12_collocations": f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)
), grams AS ({" UNION ALL ".join(_phrases(k) for k in range(1, 6))}
), candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 100
), totals AS (SELECT lang, SUM(f) AS n FROM grams WHERE k = 1 GROUP BY 1
), cuts AS (
  SELECT lang, k, phrase, f AS a, cut, array_to_string(w[1:cut], ' ') AS one, array_to_string(w[cut + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.one JOIN grams y ON y.lang = c.lang AND y.phrase = c.two
       JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, f
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates))
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND i.f >= b.a)
) WHERE rank <= 2000
""",
    "op10_urls": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path, {_rule_cases('rule')} AS rule,
       coalesce({_rule_cases('verdict')}, CASE WHEN regexp_matches(host, '{LISTED}') THEN 'block' ELSE 'allow' END) AS verdict,
       regexp_matches(host, '{LISTED}') AS listed
FROM parts
""",
}
