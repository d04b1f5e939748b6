"""Tagged documents, category links and posts, one record per line.

``<doc id="ID" url="URL" title="...">TEXT</doc>``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the tagged format.
ID_MARK = 'id="'
URL_MARK = '" url='
TEXT_MARK = '">'
END_TAG = "</doc>"


def valid_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that carry an id and a url."""
    return lines.filter(F.col(value).contains("id") & F.col(value).contains("url="))


def _span(text: Column, start: Column, length: Column) -> Column:
    return F.substring(text, start, F.greatest(length, F.lit(0)))


def document_id(line: Column) -> Column:
    start, end = F.instr(line, ID_MARK), F.instr(line, URL_MARK)
    return F.when((start > 0) & (end > 0), _span(line, start + len(ID_MARK), end - start - len(ID_MARK)))


def document_text(line: Column) -> Column:
    """What follows the opening tag, without the closing tag's length at the end."""
    mark = F.instr(line, TEXT_MARK)
    start = mark + len(TEXT_MARK)
    return F.when(mark > 0, _span(line, start, F.length(line) - len(END_TAG) - start + 1))


def _marked(line: Column) -> Column:
    return line.contains(ID_MARK) & line.contains(URL_MARK) & line.contains(TEXT_MARK)


def parse_documents(lines: DataFrame, value: str = "value") -> DataFrame:
    """``doc_id, text``; lines without the marks are left out.

    The filter looks for the marks, so that no text is cut out just to see whether it is there.
    """
    line = F.col(value)
    return lines.filter(_marked(line)).select(document_id(line).alias("doc_id"), document_text(line).alias("text"))


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``doc_id, text`` of every line, both NULL where :func:`parse_documents` leaves it out.

    Stored once, this serves the passes over the texts and the count of all lines.
    """
    line = F.col(value)
    return lines.select(
        F.when(_marked(line), document_id(line)).alias("doc_id"),
        F.when(_marked(line), document_text(line)).alias("text"),
    )


def parse_links(lines: DataFrame, value: str = "value") -> DataFrame:
    """``doc_id, category`` from the first two comma fields, without double quotes."""
    fields = lines.filter(F.col(value).contains(",")).select(F.split(F.col(value), ",", -1).alias("_f"))
    return fields.select(
        F.replace(F.get("_f", F.lit(0)), F.lit('"'), F.lit("")).alias("doc_id"),
        F.replace(F.get("_f", F.lit(1)), F.lit('"'), F.lit("")).alias("category"),
    )


def post_header(line: Column) -> Column:
    """The first tag, or the empty text."""
    return F.regexp_extract(line, "(<[^>]+>)", 1)


def post_body(line: Column) -> Column:
    """From the first ``>``, which stays, up to the closing tag.

    Without a closing tag the text ends before its last character; without any ``>`` it is empty.
    """
    start, end = F.instr(line, ">"), F.instr(line, END_TAG)
    stop = F.when(end > 0, end).otherwise(F.length(line))
    return F.when(start > 0, _span(line, start, stop - start)).otherwise(F.lit(""))


def post_category(header: Column) -> Column:
    """The text between the first two slashes, NULL without them."""
    return F.nullif(F.regexp_extract(header, "/(.*?)/", 1), F.lit(""))


def post_id(header: Column) -> Column:
    """The id in the header, or the whole header where it names none."""
    found = F.regexp_extract(header, 'id="([^"]*)"', 1)
    return F.when(found != "", found).otherwise(header)


def parse_posts(lines: DataFrame, value: str = "value") -> DataFrame:
    """``header, doc_id, category, body`` of each line; ids may be missing or repeated."""
    line, header = F.col(value), F.col("header")
    tagged = lines.select(post_header(line).alias("header"), post_body(line).alias("body"))
    return tagged.select("header", post_id(header).alias("doc_id"), post_category(header).alias("category"), "body")


def class_label(doc_id: Column, mark: str = "AU", positive: int = 1, negative: int = 0) -> Column:
    """Class of a document by a mark in its id; give ``negative=-1`` for the margin losses."""
    return F.when(doc_id.contains(mark), F.lit(positive)).otherwise(F.lit(negative))


def split_by_class(docs: DataFrame, mark: str = "AU") -> tuple[DataFrame, DataFrame]:
    """Documents with and without the mark."""
    marked = F.col("doc_id").contains(mark)
    return docs.filter(marked), docs.filter(~marked)
