"""Robots rules as array expressions: one robots text in, one ordered rule list out, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip
from .urls import percent_decode, target

RULES_TYPE = "array<struct<allow: boolean, path: string>>"
# Python's splitlines() boundaries.
_LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def _tidy(path: Column) -> Column:
    """Decoded form without the empty parameter, query and fragment marks a URL parser drops."""
    return F.regexp_replace(percent_decode(path), r";?\??#?$", "")


def _classify(line: Column) -> Column:
    """``struct<kind, value>``: blank, agent, allow, disallow, other (a rule without a path)."""
    content = strip(F.substring_index(line, "#", 1))
    key = F.lower(strip(F.substring_index(content, ":", 1)))
    value = percent_decode(strip(F.regexp_extract(content, r"(?s)^[^:]*:(.*)$", 1)))
    kind = (
        F.when(line == "", "blank")
        .when(~F.contains(content, F.lit(":")), F.lit(None))
        .when(key == "user-agent", "agent")
        .when(key.isin("allow", "disallow"), key)
        .when(key.isin("crawl-delay", "request-rate"), "other")
    )
    return F.struct(kind.alias("kind"), value.alias("value"))


def directives(body: Column) -> Column:
    """The lines that matter, in file order."""
    lines = F.transform(F.split(body, _LINE_BREAK), _classify)
    return F.filter(lines, lambda d: d["kind"].isNotNull())


def group_starts(lines: Column) -> Column:
    """0-based positions where a group begins: a blank line, or an agent not after an agent."""

    def begins(i: Column) -> Column:
        kind = F.get(lines, i)["kind"]
        before = F.coalesce(F.get(lines, i - 1)["kind"], F.lit("blank"))
        return (kind == "blank") | ((kind == "agent") & (before != "agent"))

    positions = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), begins)
    return F.when(F.size(lines) > 0, positions).otherwise(F.array().cast("array<int>"))


def rule_groups(lines: Column, starts: Column) -> Column:
    """``array<struct<agents, ruled, rules>>``; groups without an agent or a rule are dropped."""
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(lines)))
    spans = F.zip_with(
        starts,
        F.slice(ends, 1, F.size(starts)),
        lambda at, end: F.slice(lines, at + 1, end - at),
    )

    def shape(span: Column) -> Column:
        agents = F.filter(span, lambda d: d["kind"] == "agent")
        paths = F.filter(span, lambda d: d["kind"].isin("allow", "disallow"))
        return F.struct(
            F.transform(agents, lambda d: d["value"]).alias("agents"),
            F.exists(span, lambda d: ~d["kind"].isin("agent", "blank")).alias("ruled"),
            F.transform(
                paths,
                lambda d: F.struct(
                    ((d["kind"] == "allow") | (d["value"] == "")).alias("allow"),
                    _tidy(d["value"]).alias("path"),
                ),
            ).alias("rules"),
        )

    return F.filter(
        F.transform(spans, shape), lambda g: (F.size(g["agents"]) > 0) & g["ruled"]
    )


def rules_for(groups: Column, user_agent: str) -> Column:
    """Rules of the first group naming the agent, else of the first ``*`` group, else null."""
    token = user_agent.split("/")[0].lower()

    def for_all(group: Column) -> Column:
        return F.exists(group["agents"], lambda a: a == "*")

    def names_agent(group: Column) -> Column:
        hit = F.exists(group["agents"], lambda a: F.contains(F.lit(token), F.lower(a)))
        return hit & ~for_all(group)

    first_named = F.get(F.filter(groups, names_agent), F.lit(0))["rules"]
    first_for_all = F.get(F.filter(groups, for_all), F.lit(0))["rules"]
    return F.coalesce(first_named, first_for_all)


def is_allowed(rules: Column, url: Column) -> Column:
    """The first rule whose path is a prefix decides; no rule allows."""
    path = F.coalesce(F.nullif(_tidy(target(url)), F.lit("")), F.lit("/"))
    deciding = F.filter(rules, lambda r: F.startswith(path, r["path"]))
    return F.coalesce(F.get(deciding, F.lit(0))["allow"], F.lit(True))
