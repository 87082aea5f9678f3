"""All queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosta.llm import quality
from rosta.llm.abuse import LEAST, rates, scored
from rosta.llm.lookalikes import lookalike_classes, lookalike_pairs
from rosta.llm.mail import mail_lines, reduced
from rosta.llm.packing import fill, pack
from rosta.llm.personal import personal, redacted
from rosta.llm.residue import residue
from rosta.llm.tokens import encode, token_counts
from rosta.session import table


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def _packs(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, int]]:
    """The container sizes, a table of a few rows."""
    return [(r.pack_name, r.tokenizer, r.capacity) for r in table(spark, sf_dir, "pack_sizes").collect()]


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, or piece of one longer than the capacity, in its container."""
    packs = _packs(spark, sf_dir)
    sizes = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", sorted({t for _, t, _ in packs}))
    return pack(sizes, "doc_id", "tokens", packs)


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and unused room of each pack."""
    return fill(p9_containers(spark, sf_dir), _packs(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that look the same but differ in their characters."""
    return lookalike_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in classes of those that look the same, with their number of links."""
    return lookalike_classes(table(spark, sf_dir, "documents"), "doc_id", "text")


def _mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of the sites whose bodies are emails."""
    origins = table(spark, sf_dir, "sites").filter("kind = 'mail'").select("origin")
    return table(spark, sf_dir, "comments").select("row_id", "origin", "data").join(origins, "origin", "left_semi")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of emails that their sender did not newly write."""
    return mail_lines(_mails(spark, sf_dir), "row_id", "data").filter("label <> 'new'").select("row_id", "line_no")


def p6_new_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each email reduced to its new text."""
    return reduced(_mails(spark, sf_dir), "row_id", "data")


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and titles as (src, row_id, origin, text)."""
    posts = table(spark, sf_dir, "comments").select(F.lit("comments").alias("src"), "row_id", "origin", F.col("data").alias("text"))
    titles = table(spark, sf_dir, "topic_info").select(F.lit("topic_info").alias("src"), "row_id", "origin", F.col("topic_title").alias("text"))
    return posts.unionByName(titles)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and titles that are residue of templates, fillers, error pages or script notices."""
    return residue(_contents(spark, sf_dir), ["src", "row_id"], "origin", "text")


def p5_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with real content: all others."""
    contents = _contents(spark, sf_dir)
    return contents.join(p5_found(spark, sf_dir), ["src", "row_id"], "left_anti").select("src", "row_id", "text")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and ad descriptions as (src, row_id, origin, text)."""
    posts = table(spark, sf_dir, "comments").select(F.lit("comments").alias("src"), "row_id", "origin", F.col("data").alias("text"))
    ads = table(spark, sf_dir, "ad_details").select(F.lit("ad_details").alias("src"), "row_id", "origin", F.col("description").alias("text"))
    return posts.unionByName(ads)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of personal information in each text."""
    return personal(_texts(spark, sf_dir), ["src", "row_id"], "text").select("src", "row_id", "kind").distinct()


def p1_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text with placeholders for its personal information."""
    return redacted(_texts(spark, sf_dir), ["src", "row_id"], "text")


def p4_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every comment."""
    return scored(table(spark, sf_dir, "comments"), "row_id", "data")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abusive, hateful or explicit comments."""
    return p4_scores(spark, sf_dir).filter(F.col("score") >= LEAST).select("row_id")


def p4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of such comments for each origin."""
    return rates(table(spark, sf_dir, "comments"), "row_id", "origin", "data")


#: Which rows of the statistics can be cases of p7_found; the prose model is estimated over them.
JUDGED = "not mail and text_chars >= 20 and language is not null and not contact"


def _statistics(spark: SparkSession, sf_dir: str, whole_too: bool) -> DataFrame:
    """Statistics and outlierness of every text, those of the whole text beside them on demand."""
    common = [(r.lang, r.word) for r in table(spark, sf_dir, "common_words").collect()]  # a fixed list
    mails = table(spark, sf_dir, "sites").filter("kind = 'mail'").select("origin", F.lit(True).alias("mail")).distinct()
    texts = _texts(spark, sf_dir).join(mails, "origin", "left").withColumn("mail", F.coalesce("mail", F.lit(False)))
    return quality.scored(texts, ["src", "row_id", "mail"], "text", common, least=None, within=JUDGED, whole_too=whole_too)


def p7_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and outlierness of every text, emails (mail), null and empty ones among them."""
    return _statistics(spark, sf_dir, True)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are as a whole lists, tables or junk, those of p5_found left out."""
    far = _statistics(spark, sf_dir, False).filter(f"{JUDGED} and distance >= {quality.LEAST}").select("src", "row_id")
    return far.join(p5_found(spark, sf_dir), ["src", "row_id"], "left_anti")


QUERIES = {"p7_found": p7_found, "p7_statistics": p7_statistics, "p1_found": p1_found, "p1_redacted": p1_redacted, "p4_found": p4_found, "p4_scores": p4_scores, "p4_rates": p4_rates, "p5_found": p5_found, "p5_content": p5_content, "p6_found": p6_found, "p6_new_text": p6_new_text, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill, "p10_found": p10_found, "p10_classes": p10_classes}
ORACLES: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query."""
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """Name to SQL."""
    return dict(ORACLES)
