"""HTML expressions: title, noise removal, main root and block text.

Every pattern runs in about one pass over the text: where it looks for an end that can be missing, it
is given only the text up to the last such end. Opens and closes are matched over one stream of tags
with running depths, so elements may nest as deep as they like. The patterns are meant for real-world markup and are not a
full parser. Text of nested blocks (``li`` holding ``p``) is reported once, also behind the inner one.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from .text import blank_to_null, built_once, let, strip

# Element names that steer the extraction.
BLOCK_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "pre")
NOISE_TAGS = (
    "noscript", "header", "footer", "nav", "aside", "form", "svg", "iframe", "button",
)
RAW_TEXT_TAGS = ("script", "style")
ROOT_TAGS = ("article", "main", "body")

_ATTRS = r"(?:\s[^>]*)?"
_BLOCKS = "(?:" + "|".join(BLOCK_TAGS) + ")"


def _element(tag: str, end: str = "") -> str:
    return rf"<{tag}{_ATTRS}>.*?(?:</{tag}\s*>{end})"


# Script and style run to the end of the page when their close is missing, as do comments.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(_element(t, r"|\z") for t in RAW_TEXT_TAGS)
BLOCK_OPEN = rf"(?i)<{_BLOCKS}{_ATTRS}/?>"
BLOCK_CLOSE = rf"(?i)</{_BLOCKS}\s*>"
TAG = r"</?[a-zA-Z][^>]*>|<[!?][^>]*>"
ANY_TAG = r"<[^>]+>"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"

_CUT = "\x01"
_KEY = "\x02"
_OPEN, _CLOSE = "\x03", "\x04"
_COMMON = ("amp", "lt", "gt", "quot", "nbsp")
# The HTML 4 names and "apos", as one literal; common names come first because lookups scan in order.
_CODE_POINTS = {name: name2codepoint[name] for name in _COMMON} | name2codepoint | {"apos": 39}
_ENTITIES = _CUT.join(f"&{name};{_KEY}{chr(point)}" for name, point in _CODE_POINTS.items())


def _up_to_last(text: Column, end: str) -> Column:
    """The text up to and with the last match of ``end``; nothing without one."""
    return F.regexp_extract(text, f"(?is)^.*{end}", 0)


def _code_point(entity: Column) -> Column:
    hexadecimal = F.lower(F.substring(entity, 3, 1)) == "x"
    digits = F.regexp_extract(entity, r"([0-9a-fA-F]+);$", 1)
    return F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long")


def _entity_text(entity: Column) -> Column:
    point = _code_point(entity)
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    numeric = F.when(valid, char).otherwise(F.lit("�"))
    named = F.try_element_at(F.str_to_map(F.lit(_ENTITIES), F.lit(_CUT), F.lit(_KEY)), entity)
    return F.when(F.substring(entity, 2, 1) == "#", numeric).otherwise(F.coalesce(named, entity))


def unescape(text: Column) -> Column:
    """Replace character references once, left to right."""
    replaced = F.zip_with(
        F.split(text, ENTITY),
        F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), _entity_text),
        lambda plain, char: F.concat(plain, F.coalesce(char, F.lit(""))),
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(replaced, "")).otherwise(text)


@built_once
def inline_text(markup: Column, joiner: str = " ") -> Column:
    """Text between tags, each run stripped, empty runs dropped."""
    def runs(text: Column, tags: Column) -> Column:
        rest = F.substring(text, F.length(tags) + 1, F.length(text))
        return F.split(F.concat(F.regexp_replace(tags, TAG, _CUT), rest), _CUT)

    cut = let(markup, lambda text: let(_up_to_last(text, ">"), lambda tags: runs(text, tags)))
    clean = F.filter(F.transform(cut, lambda t: strip(unescape(t))), lambda t: t != "")
    return F.array_join(clean, joiner)


@built_once
def strip_hidden(html: Column) -> Column:
    """Drop comments, scripts and styles; a close tag inside a script is no real tag."""
    return F.regexp_replace(html, HIDDEN, "")


def running(items: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step(state, item)`` after every item of an array; the state is a number and begins at 0.

    States are collected in runs, as adding to an array copies it. Runs of the cube root of 2n copy
    the least: n times half a run, and half the square of the number of runs.
    """
    def after(acc: Column, item: Column) -> Column:
        return let(step(acc["state"], item).cast("int"), lambda state: F.struct(
            state.alias("state"), F.concat(acc["out"], F.array(state)).alias("out")
        ))

    def run_after(acc: Column, part: Column) -> Column:
        start = F.struct(acc["state"].alias("state"), F.array().cast("array<int>").alias("out"))
        return let(F.aggregate(part, start, after), lambda done: F.struct(
            done["state"].alias("state"), F.concat(acc["out"], F.array(done["out"])).alias("out")
        ))

    def states(items: Column, run: Column) -> Column:
        # By place: "slice" would go through the whole array for every run.
        parts = F.transform(F.sequence(F.lit(0), F.size(items) - 1, run), lambda start: F.transform(
            F.sequence(start, F.least(start + run, F.size(items)) - 1), lambda at: F.get(items, at)
        ))
        begin = F.struct(
            F.lit(0).alias("state"), F.array().cast("array<array<int>>").alias("out")
        )
        return F.flatten(F.aggregate(parts, begin, run_after)["out"])

    return let(items, lambda items: F.when(F.size(items) > 0, let(
        F.ceil(F.cbrt(2 * F.size(items))).cast("int"), lambda run: states(items, run)
    )).otherwise(F.array().cast("array<int>")))


def _sign(tag: Column) -> Column:
    return F.when(F.startswith(tag, F.lit("</")), -1).otherwise(1)


def _spans(tags: Column) -> Column:
    """``(at, to)`` of every element that no other one surrounds: places of its open and close among
    ``tags``. Opens and closes of a name are matched innermost first; others stay alone."""
    marks = F.transform(tags, lambda tag, at: F.struct(
        F.lower(F.regexp_extract(tag, "([a-zA-Z]+)", 1)).alias("name"), at.alias("at"), _sign(tag).alias("sign")
    ))

    def stepped(marks: Column) -> Column:
        # One name behind the other; the depth begins anew with each.
        return F.transform(marks, lambda m, k: F.struct(
            m["name"].alias("name"), m["at"].alias("at"), m["sign"].alias("sign"),
            ((k == 0) | (F.get(marks, k - 1)["name"] != m["name"])).alias("first"),
        ))

    def leveled(marks: Column, depths: Column) -> Column:
        def level(m: Column, k: Column) -> Column:
            before = F.when(m["first"], 0).otherwise(F.get(depths, k - 1))
            return F.when(m["sign"] > 0, before + 1).otherwise(before)

        events = F.transform(marks, lambda m, k: F.struct(
            m["name"].alias("name"), level(m, k).alias("level"), m["at"].alias("at"), m["sign"].alias("sign")
        ))
        # A close without an open has level 0. Opens and closes of one level take turns.
        return F.array_sort(F.filter(events, lambda e: e["level"] > 0))

    def paired(events: Column) -> Column:
        def pair(e: Column, k: Column) -> Column:
            after = F.get(events, k + 1)
            same = (after["name"] == e["name"]) & (after["level"] == e["level"])
            return F.when((e["sign"] > 0) & same, F.struct(e["at"].alias("at"), after["at"].alias("to")))

        return F.array_sort(F.array_compact(F.transform(events, pair)))

    def outermost(spans: Column) -> Column:
        # Crossing elements: the close of the outer one ends the inner one, too.
        def end(before: Column, span: Column) -> Column:
            return F.when(span["at"] >= before, span["to"] + 1).otherwise(before)

        return let(running(spans, end), lambda ends: F.filter(
            spans, lambda span, k: (k == 0) | (span["at"] >= F.get(ends, k - 1))
        ))

    def depth(state: Column, m: Column) -> Column:
        return F.greatest(F.lit(0), F.when(m["first"], 0).otherwise(state) + m["sign"])

    events = let(F.array_sort(marks), lambda marks: let(stepped(marks), lambda marks: let(
        running(marks, depth), lambda depths: leveled(marks, depths)
    )))
    return let(events, lambda events: let(paired(events), outermost))


def _tag_stream(names: tuple[str, ...]) -> str:
    return rf"(?i)</?(?:{'|'.join(names)}){_ATTRS}>"


@built_once
def strip_noise(html: Column) -> Column:
    """Drop page furniture with its content, at any depth. Expects ``strip_hidden`` output.

    A tag without its partner stays, and so does what stands behind it.
    """
    pattern = _tag_stream(NOISE_TAGS)

    def without(pieces: Column, tags: Column, spans: Column) -> Column:
        # The piece before a span, and from the close of each the pieces and tags up to the next.
        def stretch(start: Column, stop: Column) -> Column:
            loose = F.when(stop > start, F.array_join(F.transform(
                F.sequence(start, stop - 1), lambda at: F.concat(F.get(tags, at), F.get(pieces, at + 1))
            ), "")).otherwise("")
            return F.concat(F.get(pieces, start), loose)

        def behind(span: Column, k: Column) -> Column:
            stop = F.coalesce(F.get(spans, k + 1)["at"], F.size(tags))
            return stretch(span["to"] + 1, stop)

        first = stretch(F.lit(0), F.get(spans, F.lit(0))["at"])
        return F.concat(first, F.array_join(F.transform(spans, behind), ""))

    def bare(text: Column, head: Column) -> Column:
        rest = F.substring(text, F.length(head) + 1, F.length(text))
        tags = F.regexp_extract_all(head, F.lit(pattern), F.lit(0))
        kept = let(tags, lambda tags: let(_spans(tags), lambda spans: F.when(F.size(spans) > 0, let(
            F.split(head, pattern), lambda pieces: without(pieces, tags, spans)
        )).otherwise(head)))
        return F.concat(kept, rest)

    return let(html, lambda text: let(_up_to_last(text, ">"), lambda head: bare(text, head)))


@built_once
def extract_title(html: Column) -> Column:
    """``<title>``, else ``og:title``, else the first ``<h1>``. Expects ``strip_hidden`` output."""
    title = strip(unescape(F.regexp_extract(
        _up_to_last(html, r"</title\s*>"), rf"(?is)<title{_ATTRS}>(.*?)</title\s*>", 1
    )))
    meta = F.regexp_extract(
        _up_to_last(html, ">"), r"""(?is)<meta\s[^>]*property\s*=\s*["']?og:title["'\s/>][^>]*>?""", 0
    )
    content = F.concat(
        F.regexp_extract(meta, r"""(?is)\scontent\s*=\s*"([^"]*)\"""", 1),
        F.regexp_extract(meta, r"(?is)\scontent\s*=\s*'([^']*)'", 1),
    )
    heading = inline_text(F.regexp_extract(
        _up_to_last(html, r"</h1\s*>"), rf"(?is)<h1{_ATTRS}>(.*?)</h1\s*>", 1
    ))
    return F.coalesce(
        blank_to_null(title), blank_to_null(strip(unescape(content))), blank_to_null(heading)
    )


@built_once
def pick_root(html: Column) -> Column:
    """The first ``article``, else ``main``, else ``body``, else everything.

    An element that exists but is empty is still the root. One of the same name inside it is a part of
    it. A missing close runs to the end.
    """
    pattern = _tag_stream(ROOT_TAGS)

    def until(head: Column, rest: Column, tags: Column, start: Column, closed: Column) -> Column:
        count = F.when(closed > 0, closed).otherwise(F.size(tags) - start + 1)
        units = let(F.split(head, pattern), lambda pieces: F.zip_with(
            F.slice(tags, start, count), F.slice(pieces, start + 1, count),
            lambda tag, piece: F.struct(tag.alias("tag"), piece.alias("piece")),
        ))
        # What stands behind the close is no part of the element.
        texts = F.transform(units, lambda unit, k: F.when(k + 1 == closed, unit["tag"]).otherwise(
            F.concat(unit["tag"], unit["piece"])
        ))
        return F.concat(F.array_join(texts, ""), F.when(closed > 0, "").otherwise(rest))

    def from_open(head: Column, rest: Column, tags: Column, signs: Column) -> Column:
        def closing(start: Column) -> Column:
            inner = F.slice(signs, start, F.size(signs))
            # Tags of the other names count 0: the depth is 0 first at the close.
            return F.array_position(running(inner, lambda depth, step: depth + step), F.lit(0)).cast("int")

        return let(F.array_position(signs, F.lit(1)).cast("int"), lambda start: let(
            closing(start), lambda closed: until(head, rest, tags, start, closed)
        ))

    def of_name(head: Column, rest: Column, tags: Column, names: Column) -> Column:
        name = F.coalesce(*[F.when(F.array_contains(names, f"<{n}"), n) for n in ROOT_TAGS])
        signs = let(name, lambda name: F.transform(names, lambda tag: F.when(
            tag == F.concat(F.lit("<"), name), 1
        ).when(tag == F.concat(F.lit("</"), name), -1).otherwise(0)))
        return let(signs, lambda signs: F.when(F.array_contains(signs, 1), from_open(head, rest, tags, signs)))

    def element(text: Column, head: Column) -> Column:
        rest = F.substring(text, F.length(head) + 1, F.length(text))
        tags = F.regexp_extract_all(head, F.lit(pattern), F.lit(0))
        return let(tags, lambda tags: of_name(head, rest, tags, F.transform(
            tags, lambda tag: F.lower(F.regexp_extract(tag, "^</?[a-zA-Z]+", 0))
        )))

    return let(html, lambda text: let(
        _up_to_last(text, ">"), lambda head: F.coalesce(element(text, head), text)
    ))


@built_once
def block_text(root: Column) -> Column:
    """One line per run of text inside blocks; text outside of all blocks doesn't count."""
    plain = F.translate(root, _OPEN + _CLOSE, "")

    def marked(text: Column, tags: Column) -> Column:
        found = F.regexp_replace(F.regexp_replace(tags, BLOCK_OPEN, _OPEN), BLOCK_CLOSE, _CLOSE)
        return F.concat(found, F.substring(text, F.length(tags) + 1, F.length(text)))

    pieces = F.split(
        let(plain, lambda text: let(_up_to_last(text, ">"), lambda tags: marked(text, tags))),
        f"(?=[{_OPEN}{_CLOSE}])",
    )

    def lines(pieces: Column) -> Column:
        steps = F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit(_OPEN)), 1).when(
            F.startswith(p, F.lit(_CLOSE)), -1
        ).otherwise(0))
        depths = running(steps, lambda depth, step: F.greatest(F.lit(0), depth + step))
        inside = F.zip_with(pieces, depths, lambda p, depth: F.when(
            depth > 0, inline_text(F.translate(p, _OPEN + _CLOSE, ""))
        ))
        return F.array_join(F.filter(inside, lambda line: F.coalesce(line, F.lit("")) != ""), "\n")

    return let(pieces, lines)


@built_once
def strip_tags_fallback(html: Column) -> Column:
    """Last resort: tags become spaces, white space collapses."""
    def bare(text: Column, tags: Column) -> Column:
        rest = F.substring(text, F.length(tags) + 1, F.length(text))
        return F.concat(F.regexp_replace(tags, ANY_TAG, " "), rest)

    without = let(html, lambda text: let(_up_to_last(text, ">"), lambda tags: bare(text, tags)))
    return strip(F.regexp_replace(without, r"(?U)\s+", " "))
