"""Line dedup with a log-template tree.

A line goes down a tree of fixed depth: by its number of tokens, then by its leading tokens, where
a token with a digit counts as a variable field.  The lines of a leaf vote on the rest: a token
keeps the value that more than half of the leaf's distinct lines have, or becomes a variable
field.  A line that agrees with enough constant tokens has this template.  The others go down
further levels, by the value of one more token, and vote again; a line that agrees nowhere is a
template of its own.  The SQL of op2_line_dedup has one vote per leaf, over at most ``SLOTS`` slots.

A template found in more than one document recurs; its lines stay in the first document only.
"""

from functools import reduce

from pyspark.sql import functions as F

from civicmill.llm.common import OTHER_BLANKS, WORD, bind, pick
from civicmill.session import cut

DEPTH = 3           # leading tokens that the tree looks at
AGREE = 70          # percent of the constant tokens that must equal the template
VARY = 40           # percent of the tokens behind the leading ones that may be variable fields
# A token with a digit; it is looked for at the beginnings of tokens only.
VARIABLE = "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*"


def with_key(docs, *extra):
    """(doc_id, text, doc_key): the key is that of the id and the text, so equal rows are one document."""
    rows = pick(docs, "doc_id", "text", *extra)
    return rows.withColumn("doc_key", F.xxhash64("doc_id", "text"))


def line_words(docs, depth=DEPTH):
    """(doc_id, doc_key, pos, words, leaf, line_key) of every line with a word."""
    text = F.col("text")
    for c in OTHER_BLANKS.replace("\n", ""):
        text = F.replace(text, F.lit(c), F.lit(" "))

    def words_in(line):
        masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, "<*>")).otherwise(line)
        return F.array_remove(F.split(masked, " "), "")

    # made in the generator, which is evaluated once: a plain column would be made again by the filter below
    lines = with_key(docs).select("doc_id", "doc_key", F.posexplode(F.transform(F.split(text, "\n"), words_in)).alias("pos", "words"))
    return lines.where(F.size("words") > 0).select(
        "doc_id", "doc_key", "pos", "words", F.xxhash64(F.size("words"), F.slice("words", 1, depth)).alias("leaf"),
        F.xxhash64("words").alias("line_key"))


def forked(lines, group="leaf"):
    """The groups with different lines; only they need a template."""
    return lines.groupBy(group).agg(F.min("line_key").alias("a"), F.max("line_key").alias("b")).where("a != b").select(group)


def token_votes(lines):
    """(group, template, fork) of groups of different lines; votes are counted per value before the shuffle.

    ``fork`` is the token to part the lines by that agree with no template: of those without a
    majority the one with the fewest values, which is constant in a template that shares the group
    with others; if all have one, that of the smallest majority.  So groups shrink by a constant factor.
    """
    votes = lines.select("group", F.posexplode("slots").alias("slot", "value")).groupBy("group", "slot", "value").agg(F.count("*").alias("votes"))
    slots = votes.groupBy("group", "slot").agg(
        F.max_by("value", F.struct("votes", "value")).alias("value"), F.max("votes").alias("most"),
        F.sum("votes").alias("all"), F.count("*").alias("kinds"))
    major = 2 * F.col("most") > F.col("all")
    rank = F.struct(major.alias("major"), F.when(major, F.col("most")).otherwise(F.col("kinds")).alias("size"), "slot")
    return slots.groupBy("group").agg(
        F.sort_array(F.collect_list(F.struct("slot", F.when(major, F.col("value")).alias("value"))))["value"].alias("template"),
        F.min(rank)["slot"].alias("fork"))


def agrees(agree, vary):
    """Is the line the template's: enough constant tokens equal, and not too many tokens variable?"""
    equal = F.size(F.filter(F.zip_with("slots", "template", lambda a, b: a == b), lambda same: same))
    constant = F.size(F.filter("template", lambda value: value.isNotNull()))
    return (100 * equal >= agree * constant) & (100 * (F.size("template") - constant) <= vary * F.size("template"))


def token_templates(docs, lines, agree=AGREE, vary=VARY):
    """(line_key, template_id) of the lines that have a template, token by token.

    The tokens are read from ``docs`` once more, and only those of forked leaves are kept.  The
    distinct lines of a leaf vote; those that agree have the template.  The others are parted by
    the value of one token and vote again, until no group has different lines: a leaf has as many
    templates as its lines do.  Each round reads only the lines still open and ends in a checkpoint.
    """
    tokens = F.transform(F.slice("words", DEPTH + 1, F.size("words")), lambda token: F.hash(token))
    open_ = cut(line_words(docs).select(F.col("leaf").alias("group"), "line_key", tokens.alias("slots")).join(
        forked(lines).withColumnRenamed("leaf", "group"), "group", "left_semi").groupBy("group", "line_key").agg(
        F.any_value("slots").alias("slots")))
    found = []
    while True:
        own = F.xxhash64("group", "template")
        parted = F.xxhash64("group", "fork", F.get("slots", F.col("fork")))
        judged = cut(open_.join(token_votes(open_), "group").withColumn("same", agrees(agree, vary)).select(
            "same", "line_key", F.when(F.col("same"), own).otherwise(parted).alias("group"),
            F.when(~F.col("same"), F.col("slots")).alias("slots")))
        found.append(judged.where("same").select("line_key", F.col("group").alias("template_id")))
        rest = judged.where("not same").drop("same")
        open_ = cut(rest.join(forked(rest, "group"), "group", "left_semi"))
        if open_.isEmpty():
            return reduce(lambda a, b: a.unionAll(b), found)


def templated(docs):
    """(doc_id, doc_key, pos, template_id) of every line with a word: its template, else the line's own."""
    lines = cut(line_words(docs).drop("words"))
    found = lines.join(token_templates(docs, lines), "line_key", "left")
    return found.select("doc_id", "doc_key", "pos", F.coalesce("template_id", "line_key").alias("template_id"))


def dropped_lines(found):
    """(doc_id, doc_key, dropped): places of the lines whose template has its first document elsewhere."""
    document = F.struct("doc_id", "doc_key")
    recurring = found.groupBy("template_id").agg(F.min(document).alias("first"), F.max(document).alias("last")).where(
        "first != last").select("template_id", F.col("first")["doc_key"].alias("first_key"))
    later = found.join(recurring, "template_id").where(F.col("doc_key") != F.col("first_key"))
    return later.groupBy("doc_id", "doc_key").agg(F.collect_set("pos").alias("dropped"))


def drop_recurring_lines(docs, *extra):
    """(doc_id, text, extra columns, n_lines, n_dropped, emptied), one row per row of ``docs`` (doc_id, text).

    ``text`` is without the dropped lines.  ``emptied`` says that no word is left of a text that
    lost lines: all of it stands in earlier documents.  The first document is the one with the
    smallest id, null ids before all others.  A null text stays null and has no lines; equal rows
    are one document and get equal results; an empty table gives no rows.  Only lines without a
    word are exempt; a line of up to ``DEPTH`` tokens is its own template.
    """
    return without_lines(docs, dropped_lines(templated(docs)), extra)


def without_lines(docs, dropped, extra):
    """``docs`` without the dropped lines, and what became of each text."""
    gone = dropped.select(F.col("doc_key").alias("gone_key"), F.col("doc_id").alias("gone_id"), "dropped")
    rows = with_key(docs, *extra)
    same = (F.col("doc_key") == F.col("gone_key")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    joined = rows.join(gone, same, "left").withColumn("lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(bind(
        F.col("lines"), lambda all_: F.array_join(F.transform(stay, lambda i: F.get(all_, i)), "\n")))
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0)).cast("long")
    result = joined.select(
        "doc_id", text.alias("text"), *extra, F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.lit(0).cast("long")).otherwise(n_dropped).alias("n_dropped"))
    return result.withColumn("emptied", (F.col("n_dropped") > 0) & ~F.col("text").rlike(WORD))
