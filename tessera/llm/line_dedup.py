"""Line deduplication by site-relative frequency (DataFrame functions only).

Pages are grouped by host. A line's frequency on a host is the number of the host's pages that hold it, divided by the host's
pages; lines above a boilerplate ratio are dropped from all of that host's pages. The lines dropped on one host number at
most the host's mean of distinct lines a page divided by the ratio, so they travel as one small array a host, and the pages
themselves are joined with it without being taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, join_unique, packed, table, unpacked
from .url_filter import LOWER, UPPER, host_of

#: A line is boilerplate on a host when more than RATIO of its pages hold it and at least LEAST_PAGES do.
RATIO, LEAST_PAGES = 0.2, 3
#: Up to so many dropped lines or hosts in all (about 10 MB) are broadcast; beyond it pages and hosts are joined by shuffle.
BROADCAST_LINES = 200_000
OUTPUT = ("host", "text", "n_lines", "n_dropped")
#: Elements that end a line (fixed values).
BLOCKS = "address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
#: The same by first letter, which spares the pattern most tries.
BY_LETTER = "|".join(f"{c}(?:{'|'.join(w[1:] for w in BLOCKS.split('|') if w[0] == c)})" for c in sorted({w[0] for w in BLOCKS.split("|")}))
STRIP = (
    (r"(?is)<s(?:cript\b[^>]*>.*?</script|tyle\b[^>]*>.*?</style)\s*>", "\n"),
    (r"(?s)<!--.*?-->", ""),
    (r"[\t\n\x0B\f\r]", " "),
    (rf"(?i)</?(?:{BY_LETTER})(?:[ /][^>]*)?>", "\n"),
    (r"<[^>]*>", ""),
    (r" {2,}", " "),
)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def lines_of_html(html: Column) -> Column:
    """The lines of a page, one for each block, without scripts, styles and markup; some may be empty."""
    text = F.coalesce(html, F.lit(""))
    for pattern, by in STRIP:
        text = F.regexp_replace(text, pattern, by)
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def lines_of_text(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_dedup(pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO, least_pages: int = LEAST_PAGES, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Each row of ``pages`` with ``host, text, n_lines, n_dropped``: its lines but for its host's boilerplate.

    ``lines`` is an array (null: none), as :func:`lines_of_text` and :func:`lines_of_html` give it. A null host is a host like others, the empty one. Empty lines are no lines
    and vanish. A line repeated in a page counts once for it, and repeated rows are pages of their own. Input columns named
    like an output are replaced; an empty table gives an empty result.
    """
    rows = pages.select(packed(pages, OUTPUT, keep), F.coalesce(host, F.lit("")).alias("host"), F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x != "").alias("__lines"))
    digest = lambda x: F.unhex(F.md5(x.cast("binary")))  # noqa: E731  16 bytes a line, whatever its length
    counts = rows.select("host", F.explode(F.array_distinct(F.transform("__lines", digest))).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # A host with fewer pages than least_pages has no boilerplate; the counts are few after the filter, the totals one a host.
    totals = checkpoint(totals)
    if totals.count() <= BROADCAST_LINES:
        met = counts.join(F.broadcast(totals), "host")
    else:
        met = join_unique(counts, totals, "host", F.col("pages"), max(1, pages.count()))
    common = met.where(F.col("n") > F.lit(float(ratio)) * F.col("pages"))
    dropped = common.groupBy("host").agg(F.collect_list("line").alias("__drop"), F.first("pages").alias("pages"))
    dropped = checkpoint(dropped)
    if (dropped.agg(F.coalesce(F.sum(F.size("__drop")), F.lit(0))).first()[0]) <= BROADCAST_LINES:
        out = rows.join(F.broadcast(dropped), "host", "left")
    else:
        out = join_unique(rows, dropped, "host", F.col("pages"), max(1, pages.count()), "left")
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter("__lines", lambda x: ~F.array_contains("__drop", digest(x))))
    out = out.withColumn("__kept", kept)
    return out.select(*unpacked(out), "host", F.array_join("__kept", "\n").alias("text"), F.size("__lines").cast("long").alias("n_lines"), (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's text without the lines that are boilerplate on its host."""
    pages = table(spark, sf_dir, "pages")
    return line_dedup(pages, host_of(F.col("url")), lines_of_html(F.col("html")), keep=("page_id",)).select("page_id", *OUTPUT)


def _sql() -> str:
    text = "coalesce(html, '')"
    for pattern, by in STRIP:
        text = f"regexp_replace({text}, '{pattern}', '{'{NL}' if by == chr(10) else by}', 'g')"
    for name, char in ENTITIES:
        text = f"replace({text}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    text = text.replace("'{NL}'", "chr(10)")
    lines = f"list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' '))"
    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, {lines} AS a FROM pages),
q AS (SELECT page_id, host, list_filter(a, lambda x: x <> '') AS a, row_number() OVER () AS r FROM p),
l AS (SELECT r, page_id, host, unnest(a) AS line, unnest(range(len(a))) AS i FROM q),
c AS (SELECT host, line, count(DISTINCT r) AS n FROM l GROUP BY host, line),
b AS (SELECT c.host, c.line FROM c JOIN (SELECT host, count(*) AS pages FROM q GROUP BY host) t ON c.host = t.host WHERE n >= {LEAST_PAGES} AND n > {RATIO} * pages),
k AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY i) AS text, count(*) AS n FROM l LEFT JOIN b ON l.host = b.host AND l.line = b.line WHERE b.line IS NULL GROUP BY l.r)
SELECT q.page_id, q.host, coalesce(k.text, '') AS text, CAST(len(q.a) AS BIGINT) AS n_lines, CAST(len(q.a) - coalesce(k.n, 0) AS BIGINT) AS n_dropped
FROM q LEFT JOIN k ON q.r = k.r
"""


SQL = _sql()
