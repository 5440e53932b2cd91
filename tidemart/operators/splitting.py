"""One log stream into error, start, play, display, action and page streams.

Input: log lines as JSON text in column `value`; other columns go along. Each line is parsed once, into the texts of its
members. A record that nothing is taken from goes on as it came; from others members are left out and the rest stays in its
order, known or not, repeated keys included. Only the spelling of numbers may change there (1.10 is written 1.1). Of a
repeated member the last one counts, as in logs.parse_log. An `is_new` column, if there is one, replaces the field of that
name in `common`. Lines that are no JSON object give no rows here; they are the lines that logs.split_dirty gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions import jsontext

MEMBERS = ("common", "page", "displays", "actions", "start", "err", "appVideo", "ts")
REC, KNOWN, PARTS = "_rec", "_known", "_parts"
IS_NEW = '"is_new"\\s*:\\s*("(?:[^"\\\\]|\\\\.)*"|[^,}\\s]+)'


def _opened(lines: DataFrame, broken: bool = False) -> DataFrame:
    """Lines with their members' texts: REC all names and texts, KNOWN those with names in MEMBERS; the text of common with
    the corrected is_new, and whether that differs from what came. Broken lines too if asked for.

    Each step is evaluated once, however many outputs look at it.
    """
    rows = jsontext.member_texts(lines, "value", MEMBERS, REC)
    rows = rows if broken else rows.where(F.col(REC).isNotNull())
    texts = [F.get(F.col(REC)["texts"], F.array_position(F.col(REC)["names"], m).cast("int") - 1).alias(m) for m in MEMBERS]
    rows = jsontext.with_once(rows, KNOWN, F.struct(*texts))
    common, changed = _member("common"), F.lit(False)
    if "is_new" in lines.columns:
        # The value needs no escape, it is 0 or 1. The old one is replaced where it stands, a missing one goes first.
        old = F.regexp_extract(common, IS_NEW, 1)
        field = F.concat(F.lit('"is_new":"'), F.col("is_new"), F.lit('"'))
        rest = F.ltrim(F.substr(F.ltrim(common), F.lit(2)))
        new = (F.when(old != "", F.regexp_replace(common, F.lit(IS_NEW), field))
               .when(rest.startswith("}"), F.concat(F.lit("{"), field, rest)).otherwise(F.concat(F.lit("{"), field, F.lit(","), rest)))
        changed = F.coalesce(common.startswith("{") & (F.col("is_new") != F.trim(old, F.lit('"'))), F.lit(False))
        common = F.when(changed, new).otherwise(common)
    parts = F.struct(common.alias("common"), changed.alias("changed"),
                     *[F.when(is_page(), jsontext.items(_member(m))).alias(m) for m in ("displays", "actions")])
    return jsontext.with_once(rows, PARTS, parts)


def _member(name: str) -> Column:
    """The text of a member, null if it is not there."""
    return F.col(KNOWN)[name]


def _has(name: str) -> Column:
    return F.coalesce(_member(name) != "null", F.lit(False))


def has_error() -> Column:
    return _has("err")


def is_start() -> Column:
    return _has("start")


def is_video() -> Column:
    return ~_has("start") & _has("appVideo")


def is_page() -> Column:
    return ~_has("start") & ~_has("appVideo")


def _without(*names: str) -> Column:
    """The record as text without some of its members."""
    there, common = F.col(REC)["names"], F.col(PARTS)["common"]
    parts = F.zip_with(there, F.col(REC)["texts"], lambda name, text: F.when(
        ~name.isin(*names) if names else F.lit(True),
        F.concat(jsontext.quoted(name), F.lit(":"), F.when(name == "common", common).otherwise(text))))
    rebuilt = F.concat(F.lit("{"), F.array_join(F.reverse(parts), ","), F.lit("}"))  # parts left out are null
    whole = ~F.col(PARTS)["changed"]
    for name in names:
        whole = whole & ~F.array_contains(there, name)
    return F.when(whole, F.col("value")).otherwise(rebuilt)


def _items(name: str, field: str, *others: str) -> Column:
    """Per element of an array member: the element as `field`, common, and other members."""
    tail = F.concat(F.coalesce(F.concat(F.lit(',"common":'), F.col(PARTS)["common"]), F.lit("")),
                    *[F.when(_has(o), F.concat(F.lit(f',"{o}":'), _member(o))).otherwise("") for o in others],
                    F.lit("}"))
    return F.transform(jsontext.item_texts(_member(name), F.col(PARTS)[name]), lambda item: F.concat(F.lit(f'{{"{field}":'), item, tail))


DISPLAYS = ("displays", "display", "page", "ts")
ACTIONS = ("actions", "action", "page")
PAGE_DROPS = ("displays", "actions", "err")


def _rest(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c not in ("value", "is_new")]


def explode_displays(lines: DataFrame) -> DataFrame:
    """One record per display of a page record, with common, page and ts."""
    return _opened(lines).where(is_page()).select(*_rest(lines), F.explode(_items(*DISPLAYS)).alias("value"))


def explode_actions(lines: DataFrame) -> DataFrame:
    """One record per action of a page record, with common and page."""
    return _opened(lines).where(is_page()).select(*_rest(lines), F.explode(_items(*ACTIONS)).alias("value"))


def page_only(lines: DataFrame) -> DataFrame:
    """Page records without displays, actions and error."""
    return _opened(lines).where(is_page()).select(*_rest(lines), _without(*PAGE_DROPS).alias("value"))


def split_log(lines: DataFrame, dirty: bool = False) -> DataFrame:
    """(topic, value): every output of every record in one pass over the input.

    A record with an error goes out whole to the error topic and goes on without it, to exactly
    one of start, play and page; a page also gives one row per display and action. With `dirty`, lines that are no JSON
    object go to the dirty topic.
    """
    def one(condition: Column, topic: str, value: Column) -> Column:
        return F.when(condition, F.array(F.struct(F.lit(topic).alias("topic"), value.alias("value"))))

    def many(topic: str, items: Column) -> Column:
        return F.when(is_page(), F.transform(items, lambda value: F.struct(F.lit(topic).alias("topic"), value.alias("value"))))

    rows, broken = _opened(lines, dirty), F.col(REC).isNull()
    outputs = [
        one(broken, fixed.LOG_DIRTY, F.col("value")),
        one(~broken & has_error(), fixed.LOG_ERR, _without()),
        one(~broken & is_start(), fixed.LOG_START, _without("err")),
        one(~broken & is_video(), fixed.LOG_VIDEO, _without("err")),
        one(~broken & is_page(), fixed.LOG_PAGE, _without(*PAGE_DROPS)),
        many(fixed.LOG_DISPLAY, _items(*DISPLAYS)),
        many(fixed.LOG_ACTION, _items(*ACTIONS)),
    ]
    none = F.array().cast("array<struct<topic:string,value:string>>")
    out = F.concat(*[F.coalesce(o, none) for o in outputs])
    # In a column of its own, so that it is compiled.
    return rows.select(*_rest(lines), out.alias("_out")).select(*_rest(lines), F.inline("_out"))
