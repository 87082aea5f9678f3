"""Corpus tools over topic documents: validity, texts, words, rows, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosta.functions.text import count_words, one_line, words
from rosta.functions.urls import page_number
from rosta.operators.shredding import parse


def texts_of(value: object, ads: bool = False) -> list[str] | None:
    """Main content and comment texts of a document in order, or None where its shape does not allow to read them.

    Values that are no text are left out, and so are ``comments`` that are no list (null among them); a document, a header or a
    record of another shape than an object fails.
    """
    if not isinstance(value, dict):
        return None
    header = value.get("data", {})
    if not isinstance(header, dict):
        return None
    out = [header.get("content")]
    for part in ("comments", "ads") if ads else ("comments",):
        records = value.get(part, [])
        for record in records if isinstance(records, list) else []:
            if not isinstance(record, dict):
                return None
            out.append(record.get("data"))
    return [t for t in out if type(t) is str]


def documents(df: DataFrame, key: str, raw: str, ads: bool = False) -> DataFrame:
    """(key, status, texts) for every document: ``complete`` or ``badformat``, and its texts or null where they cannot be read.

    NaN and Infinity count as values here, though they are not JSON. A failing document fails alone.
    """

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            status, texts = [], []
            for text in given.column(1).to_pylist():
                valid, value = parse(text, strict=False)
                status.append("complete" if valid else "badformat")
                found = texts_of(value, ads) if valid else None
                texts.append(None if found is None else [t.encode("utf-8", "replace").decode() for t in found])
            yield pa.RecordBatch.from_arrays([given.column(0), pa.array(status), pa.array(texts, pa.list_(pa.string()))], names=["_key", "status", "texts"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{raw}`").alias("_raw")).mapInArrow(run, f"_key {kind}, status string, texts array<string>").withColumnRenamed("_key", key)


def word_counts(docs: DataFrame, key: str) -> DataFrame:
    """(key, words) of the documents that can be read."""
    total = F.aggregate(F.transform("texts", count_words), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return docs.filter("texts is not null").select(key, total.alias("words"))


def totals(docs: DataFrame) -> DataFrame:
    """(status, files): rows per status and, under the null status, all of them."""
    return docs.rollup("status").agg(F.count("*").alias("files"))


def dump(docs: DataFrame, key: str, rows: bool = False) -> DataFrame:
    """(key, text_no, place, item): the words of each text in order, or its one-line form where that is not blank."""
    each = docs.select(key, F.posexplode("texts").alias("text_no", "text"))
    if rows:
        return each.select(key, "text_no", F.lit(0).alias("place"), one_line(F.col("text")).alias("item")).filter("item <> ''")
    return each.select(key, "text_no", F.posexplode(words(F.col("text"))).alias("place", "item"))


def repaired(raw: Column) -> Column:
    """A text whose first array of comments has a line that begins with a comma before its first object, without that comma; any other text as it is."""
    return F.regexp_replace(raw, r'(?s)\A(.*?"comments"\s*:\s*\[\s*)\r?\n\s*,(\s*\{)', "$1\n$2")


def repair_counts(df: DataFrame, raw: str) -> DataFrame:
    """(seen, changed): documents and those that the repair changes."""
    changed = F.coalesce(repaired(F.col(f"`{raw}`")) != F.col(f"`{raw}`"), F.lit(False))
    return df.agg(F.count("*").alias("seen"), F.count_if(changed).alias("changed"))


def word_totals(docs: DataFrame) -> DataFrame:
    """(words, processed, failed) over all documents, one row; a document that cannot be read has no words."""
    total = F.aggregate(F.transform("texts", count_words), F.lit(0).cast("bigint"), lambda a, b: a + b)
    readable = F.col("texts").isNotNull()
    return docs.agg(F.coalesce(F.sum(total), F.lit(0)).alias("words"), F.count_if(readable).alias("processed"), F.count_if(~readable).alias("failed"))


#: Ways in which sites mark that a document is complete.
CLOSED = ("tail", "status")


def closed(raw: Column, rule: str = "tail") -> Column:
    """Whether a document's text is finished: it ends in ``]}`` or in ``]`` and, on a line of its own, ``}`` (``tail``), or says so in its trailer (``status``).

    The end is looked at in the text itself, stripped of white space; the status is read by the JSON path ``extra.scrape_status``,
    and only from documents with a list of comments.
    """
    if rule == "tail":
        return F.coalesce(raw.rlike(r"(?s)\](?:\r?\n)?\}\s*\z"), F.lit(False))
    status, comments = F.get_json_object(raw, "$.extra.scrape_status"), F.get_json_object(raw, "$.comments")
    return F.coalesce((status == "finished") & comments.startswith("["), F.lit(False))


def has_items(raw: Column) -> Column:
    """Whether a document's text holds at least one item: an object behind the head of its list of comments."""
    return F.coalesce(raw.rlike(r'"comments"\s*:\s*\[\s*\{'), F.lit(False))


def last_saved(raw: Column) -> Column:
    """struct(comment_id, url, next_url, offset, page): where a document that is no finished one can be resumed."""
    url = last_field(raw, "url")
    number = F.try_element_at(F.regexp_extract_all(raw, F.lit(r'"list_offset"\s*:\s*(\d+)'), F.lit(1)), F.lit(-1)).try_cast("bigint")
    return F.struct(last_field(raw, "comment_id").alias("comment_id"), url.alias("url"), last_field(raw, "next_resume_url").alias("next_url"), number.alias("offset"), page_number(url).alias("page"))


def resume_offset(start: Column, saved: Column) -> Column:
    """Offset to resume a list at: the larger of the start and the last saved one."""
    return F.greatest(start, saved)


def last_field(raw: Column, field: str) -> Column:
    """Last value of a text field in the raw JSON of a document, without parsing it; null without one."""
    return F.nullif(F.regexp_extract(F.try_element_at(F.regexp_extract_all(raw, F.lit(rf'"{field}"\s*:\s*"[^"]*"'), F.lit(0)), F.lit(-1)), r':\s*"([^"]*)"$', 1), F.lit(""))
