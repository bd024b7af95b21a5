"""HTML fragments as SQL expressions.

Pages are cut with regular expressions inside the JVM, so a page never goes
through a Python worker. Elements that can contain their own kind (div, span,
ul, table) are closed by counting opening and closing tags.

The functions take and return SQL text for ``F.expr``: one expression is then
one call into Spark instead of one per node of its tree.
"""

from __future__ import annotations

import json
from html.entities import html5

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = r"(?s)<(?:/?[a-zA-Z][^>]*|!--.*?--|![^>]*)>"
_BLANK = r"[\s\x1c-\x1f]"
_FLAT_TAGS = {"h1", "h2", "h3", "a"}
_ENTITY = r"&(?:#[xX]0*[0-9a-fA-F]{1,6};?|#0*[0-9]{1,7};?|[a-zA-Z][a-zA-Z0-9]*;?)"
# In an address, a name without its semicolon is a parameter.
_CLOSED_ENTITY = r"&(?:#[xX]0*[0-9a-fA-F]{1,6}|#0*[0-9]{1,7}|[a-zA-Z][a-zA-Z0-9]*);"
# Numbered references 128 to 159 mean the characters of Windows code page 1252.
_C1 = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")
# End of fixed values.


# What stands in a tag before an attribute: values in quotes are passed over as a whole.
_BEFORE = r"""(?:[^\s>"']++|\s(?!{name}\s*=)|"[^"]*+"|'[^']*+')*+"""


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# A map is searched from its start: the references that pages are full of come before it.
_COMMON = ["&amp;", "&lt;", "&gt;", "&quot;", "&nbsp;", "&apos;"]
_NAMED = f"from_json({literal(json.dumps({f'&{k}': v for k, v in html5.items()}))}, 'map<string,string>')"


def _named(reference: str) -> str:
    """Character of a named reference, NULL for an unknown name."""
    common = " ".join(f"WHEN {literal(name)} THEN {literal(html5[name[1:]])}" for name in _COMMON)
    return f"CASE {reference} {common} ELSE element_at({_NAMED}, {reference}) END"


def has_class(name: str) -> str:
    """Condition on a tag: its first class attribute lists ``name``, in this case."""
    listed = rf"""(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))"""
    return rf"""(?={_BEFORE.format(name="class")}\sclass\s*=\s*(?-i:{listed}))"""


def has_id(name: str) -> str:
    """Condition on a tag: its first id attribute is ``name``, in this case."""
    return rf"""(?={_BEFORE.format(name="id")}\sid\s*=\s*(?-i:"{name}"|'{name}'|{name}(?=[\s>])))"""


def opening(tag: str, condition: str = "") -> str:
    """Pattern of an opening tag."""
    return rf"(?is)<{tag}\b{condition}{_ATTRS}>"


def _until(tag: str, start_ends: bool = False) -> str:
    """Pattern of everything up to the end tag (or, with ``start_ends``, the next start) of an element."""
    return rf"(?:[^<]++|<(?!/{'?' if start_ends else ''}{tag}\b))*+"


def visible(html: str) -> str:
    """The page without script and style bodies; comments stay as empty marks between texts."""
    pattern = r"(?is)<(?:!--.*?-->|(script|style)\b.*?</\1\s*>)"
    return f"regexp_replace({html}, {literal(pattern)}, '<!>')"


def strip(text: str) -> str:
    """Trim every kind of white space, not only blanks."""
    return f"regexp_replace({text}, {literal(rf'(?U)^{_BLANK}+|{_BLANK}+$')}, '')"


def decode_entities(text: str, closed_only: bool = False) -> str:
    """Replace named and numbered character references; unknown names stay as they are.

    ``closed_only`` leaves references without a semicolon alone.
    """
    entity = _CLOSED_ENTITY if closed_only else _ENTITY
    number = """IF(c RLIKE '^&#[xX]', conv(regexp_extract(c, '^&#[xX]([0-9a-fA-F]+);?$', 1), 16, 10), regexp_extract(c, '^&#([0-9]+);?$', 1))"""
    plain = "decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32')"
    character = f"IF(n BETWEEN 128 AND 159, substring({literal(_C1)}, CAST(n - 127 AS INT), 1), {plain})"
    valid = "n BETWEEN 1 AND 1114111 AND n NOT BETWEEN 55296 AND 57343"
    numbered = f"get(transform(array(CAST({number} AS BIGINT)), n -> IF({valid}, {character}, '�')), 0)"
    decoded = f"""CASE WHEN NOT c RLIKE {literal(f"^{entity}$")} THEN c WHEN startswith(c, '&#') THEN {numbered}
      ELSE coalesce({_named('c')}, c) END"""
    pieces = f"regexp_extract_all({text}, {literal(f'{entity}|[^&]+|&')}, 0)"
    return f"IF(contains({text}, '&'), array_join(transform({pieces}, c -> {decoded}), ''), {text})"


def _split(name: str, pattern: str) -> str:
    """``split`` of the text called ``name``.

    Spark's own compiles its pattern for every row, ``regexp_replace`` does not; so the separators become one character
    that the text does not hold, and the text is split there.
    """
    found = literal(pattern)
    return f"IF(contains({name}, chr(1)), split({name}, {found}), split(regexp_replace({name}, {found}, chr(1)), chr(1)))"


def text_nodes(fragment: str) -> str:
    """Stripped, non-empty texts of a fragment in document order."""
    # Bound to a name, so that the fragment is cut out once; most cells hold no tag at all.
    pieces = f"CASE WHEN contains(f, '<') THEN {_split('f', _TAG)} WHEN f IS NOT NULL THEN array(f) END"
    nodes = f"transform(get(transform(array({fragment}), f -> {pieces}), 0), t -> {strip(decode_entities('t'))})"
    return f"filter({nodes}, t -> t <> '')"


def text_of(fragment: str, separator: str = "") -> str:
    return f"array_join({text_nodes(fragment)}, {literal(separator)})"


def _balanced(element: str, tag: str) -> str:
    """Inner HTML of the element that ``element`` starts with; what follows its end tag is dropped.

    The pieces after the first start with "tag" or "/tag". The fold over them counts the
    depth and how many pieces belong to the element; the array of one splits only once.
    """
    depth = "(d.depth + IF(startswith(p, '/'), -1, 1))"
    step = f"IF(d.depth = 0 AND d.kept > 0, d, named_struct('depth', {depth}, 'kept', d.kept + IF({depth} > 0, 1, 0)))"
    kept = f"aggregate(slice(s, 2, size(s)), named_struct('depth', 0, 'kept', 0), (d, p) -> {step}, d -> d.kept)"
    split = _split("f", rf"<(?=/?(?i:{tag})\b)")
    whole = f"get(transform(transform(array({element}), f -> {split}), s -> concat('<', array_join(slice(s, 2, {kept}), '<'))), 0)"
    return f"regexp_replace({whole}, {literal(f'^{opening(tag)}')}, '')"


def first_inner(html: str, tag: str, condition: str = "") -> str:
    """Inner HTML of the first such element, NULL when there is none."""
    start = opening(tag, condition)
    flat = f"{start}({_until(tag)})"
    if tag in _FLAT_TAGS:
        element, inner = flat, f"regexp_extract(e, {literal(flat)}, 1)"
    else:
        element, inner = f"{start}.*", _balanced("e", tag)
    found = f"filter(array(regexp_extract({html}, {literal(element)}, 0)), e -> e <> '')"
    return f"get(transform({found}, e -> {inner}), 0)"


def all_inner(html: str, tag: str, condition: str = "") -> str:
    """Inner HTML of each such element as an array (an inner match ends the outer one)."""
    start = opening(tag, condition)
    if tag in _FLAT_TAGS:
        return f"regexp_extract_all({html}, {literal(f'{start}({_until(tag)})')}, 1)"
    parts = f"split({html}, {literal(f'(?={start})')})"
    return f"transform(filter({parts}, e -> e RLIKE {literal(f'^{start}')}), e -> {_balanced('e', tag)})"


def flat_elements(fragment: str, tag: str) -> str:
    """Inner HTML of elements that do not nest (tr, td, th); a missing end tag ends at the next start."""
    pattern = rf"(?i)<{tag}\b[^>]*>({_until(tag, start_ends=True)})"
    return f"regexp_extract_all({fragment}, {literal(pattern)}, 1)"


def anchors(fragment: str) -> str:
    """(href, text) of each link that has an href, in document order."""
    pattern = rf"(?i)<a\b(?=[^>]*\shref\s*=){_ATTRS}>{_until('a', start_ends=True)}"
    quoted = literal(r"""(?is)^<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
    href = "concat(" + ", ".join(f"regexp_extract(a, {quoted}, {i})" for i in (1, 2, 3)) + ")"
    link = f"named_struct('href', {decode_entities(href, closed_only=True)}, 'text', {text_of('a')})"
    return f"transform(regexp_extract_all({fragment}, {literal(pattern)}, 0), a -> {link})"
