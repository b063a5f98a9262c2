"""HTML bodies as arrays of tokens: one tokenizer, and expressions over its output.

`html_tokens` is the only Python code that looks at page text. Its result is one array per page,
in which every element knows where it ends; everything after that is built-in array functions,
written as SQL over the name of a token column.

Nesting rule: an end tag closes the nearest open element of its name and all elements inside it;
an end tag with no open element is ignored; what is open at the end of the text is closed there;
void elements never open; `script` and `style` hold raw text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import IMAGE_EXTENSION, THUMBNAIL_FOLDER, col, let, literal, strip_sql

# Executors get the tokenizer with the task and need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = (
    "struct<pos: int, kind: string, tag: string, attrs: map<string, string>, classes: array<string>,"
    " raw: string, text: string, last: int, parent: int>"
)

# Elements that never have content.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)

START, END, TEXT, COMMENT, OTHER = "start", "end", "text", "comment", "other"


def _escape(text: str) -> str:
    if "&" not in text and "<" not in text and ">" not in text:
        return text
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(value: str) -> str:
    value = _escape(value)
    if '"' not in value:
        return f'"{value}"'
    return '"' + value.replace('"', "&quot;") + '"' if "'" in value else f"'{value}'"


class _Tokenizer(HTMLParser):
    """Appends the tokens of one text after another to one list."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tokens = []  # (kind, tag, raw, text, parent, number of attributes, number of classes)
        self.last = []
        self.attributes = []  # (name, value), token after token
        self.classes = []
        self.offsets = [0]

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def tokenize(self, text):
        self.reset()
        self.base = len(self.tokens)
        self.open = []
        self.count = {}
        self.parent = -1
        self.feed(text)
        self.close()
        while self.open:
            self._close_top()
        self.offsets.append(len(self.tokens))

    def _add(self, kind, tag=None, raw="", text=None, attributes=0, classes=0):
        pos = len(self.tokens) - self.base
        self.tokens.append((kind, tag, raw, text, self.parent, attributes, classes))
        self.last.append(pos)
        return pos

    def _close_top(self):
        pos, tag = self.open.pop()
        self.count[tag] -= 1
        self.last[self.base + pos] = self._add(END, tag, raw=f"</{tag}>")
        self.parent = self.open[-1][0] if self.open else -1

    def _start(self, tag, attrs, empty):
        classes = ()
        written = f"<{tag}"
        if attrs:
            attrs = {name: value or "" for name, value in attrs}
            classes = attrs.get("class", "").split()
            self.attributes.extend(attrs.items())
            self.classes.extend(classes)
            written += "".join([f" {name}={_quoted(value)}" for name, value in attrs.items()])
        void = tag in VOID
        raw = written + ("/>" if void else ">")
        pos = self._add(START, tag, raw, self.get_starttag_text(), len(attrs), len(classes))
        if void:
            return
        self.open.append((pos, tag))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.parent = pos
        if empty:
            self._close_top()

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, False)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, True)

    def handle_endtag(self, tag):
        if self.count.get(tag):
            while self.open[-1][1] != tag:
                self._close_top()
            self._close_top()

    def handle_data(self, data):
        literal = bool(self.open) and self.open[-1][1] in ("script", "style")
        # Scripts and style sheets are kept as they are and are no part of the page's text.
        self._add(TEXT, raw=data if literal else _escape(data), text="" if literal else data)

    def handle_comment(self, data):
        self._add(COMMENT, raw=f"<!--{data}-->", text=data)

    def handle_decl(self, decl):
        self._add(OTHER, raw=f"<!{decl}>")

    def unknown_decl(self, data):
        self._add(OTHER, raw=f"<![{data}]>")

    def handle_pi(self, data):
        self._add(OTHER, raw=f"<?{data}>")


_ARROW_TOKEN = pa.struct(
    [
        ("pos", pa.int32()),
        ("kind", pa.string()),
        ("tag", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("classes", pa.list_(pa.string())),
        ("raw", pa.string()),
        ("text", pa.string()),
        ("last", pa.int32()),
        ("parent", pa.int32()),
    ]
)


def _offsets(counts) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts, dtype=np.int32)]).astype(np.int32))


def _strings(values) -> pa.Array:
    return pa.array(values, type=pa.string())


def _tokens_of(html: pa.Array) -> pa.Array:
    tokenizer = _Tokenizer()
    for text in html.to_pylist():
        tokenizer.tokenize(text or "")
    ends = np.array(tokenizer.offsets, dtype=np.int32)
    pos = np.arange(ends[-1], dtype=np.int32) - np.repeat(ends[:-1], np.diff(ends))
    kind, tag, raw, text, parent, attributes, classes = zip(*tokenizer.tokens) if tokenizer.tokens else ((),) * 7
    names, values = zip(*tokenizer.attributes) if tokenizer.attributes else ((), ())
    arrays = [
        pa.array(pos),
        _strings(kind),
        _strings(tag),
        pa.MapArray.from_arrays(_offsets(attributes), _strings(names), _strings(values)),
        pa.ListArray.from_arrays(_offsets(classes), _strings(tokenizer.classes)),
        _strings(raw),
        _strings(text),
        pa.array(tokenizer.last, type=pa.int32()),
        pa.array(parent, type=pa.int32()),
    ]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(arrays, fields=list(_ARROW_TOKEN)))


# Bytes of text whose tokens are held and handed back at once; they take many times the memory of the text.
PIECE_BYTES = 1 << 20


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """`texts` cut into stretches of about PIECE_BYTES: texts that begin in the same PIECE_BYTES stay together."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = (np.cumsum(sizes) - sizes) // PIECE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    for first, end in zip(edges, edges[1:]):
        yield texts.slice(first, end - first)


def html_tokens(html) -> Column:
    """Tokens of each page; marked nondeterministic so that a plan never computes them twice."""

    @F.arrow_udf(f"array<{TOKEN}>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # A batch is cut by rows, whatever the pages' lengths; memory follows the piece.
        for texts in batches:
            for piece in _pieces(texts):
                yield _tokens_of(piece)

    return tokens.asNondeterministic()(col(html))


class _LinkReader(HTMLParser):
    """The href of every link, as `_Tokenizer` has it; nothing else of the text is kept."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs = []
        self.offsets = [0]

    def updatepos(self, i, j):
        return j

    def read(self, text):
        self.reset()
        self.feed(text)
        self.close()
        self.offsets.append(len(self.hrefs))

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            attrs = dict(attrs)
            if "href" in attrs:
                self.hrefs.append(attrs["href"] or "")


def _hrefs_of(html: pa.Array) -> pa.Array:
    reader = _LinkReader()
    for text in html.to_pylist():
        reader.read(text or "")
    return pa.ListArray.from_arrays(pa.array(reader.offsets, type=pa.int32()), _strings(reader.hrefs))


def html_hrefs(html) -> Column:
    """The href of each of a page's links, in order, without making its tokens."""

    @F.arrow_udf("array<string>")
    def hrefs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for piece in _pieces(texts):
                yield _hrefs_of(piece)

    return hrefs.asNondeterministic()(col(html))


# --- reading tokens -------------------------------------------------------------------------
#
# Functions with a leading underscore, and the tests for `elements` and `drop`, give SQL text;
# `t` is the SQL name of a token there. The others give columns.


def _image_id(uri: str) -> str:
    folder, name = f"regexp_extract({uri}, r'{THUMBNAIL_FOLDER}', 1)", f"substring_index({uri}, '/', -1)"
    return f"regexp_replace(if(contains({uri}, 'thumb'), {folder}, {name}), r'{IMAGE_EXTENSION}', '$1')"


def has_class(t: str, name: str) -> str:
    """The element has class `name`, or its class attribute is exactly `name`."""
    return f"coalesce(array_contains({t}.classes, {literal(name)}) OR {t}.attrs['class'] = {literal(name)}, false)"


def is_start(t: str, *tags: str) -> str:
    named = f" AND {t}.tag IN ({', '.join(literal(x) for x in tags)})" if tags else ""
    return f"({t}.kind = 'start'{named})"


def _elements(tokens: str, test) -> str:
    return f"filter({tokens}, t -> {test('t')})"


# A page's tokens stay where they are: token `pos` is the `pos`th of its array (from 0), also after steps that take elements
# out or put markup in. So a stretch of a page is a slice, and no step looks at every token for each element.


def _slice(tokens: str, first: str, end: str) -> str:
    """Tokens from position `first` up to, not including, `end`."""
    return f"slice({tokens}, {first} + 1, greatest(0, {end} - ({first})))"


def _inside(tokens: str, element: str, offset: str = "0") -> str:
    """Tokens between an element's start and end; `offset` is the position of the first token of `tokens`."""
    return _slice(tokens, f"{element}.pos + 1 - {offset}", f"{element}.last - {offset}")


def between(tokens: str, before: str, behind: str) -> str:
    """Tokens after position `before` and before position `behind`, as SQL."""
    return _slice(tokens, f"{before} + 1", f"least({behind}, size({tokens}))")


def _render(tokens: str) -> str:
    return f"array_join(transform({tokens}, t -> t.raw), '')"


def _plain_text(tokens: str) -> str:
    return f"array_join(transform(filter({tokens}, t -> t.kind = 'text'), t -> t.text), '')"


def elements(tokens: str, test) -> Column:
    return F.expr(_elements(tokens, test))


def render(tokens: str) -> Column:
    return F.expr(_render(tokens))


def plain_text(tokens: str) -> Column:
    return F.expr(_plain_text(tokens))


def not_published_encyc(tokens: str) -> Column:
    """The body has a marker div that keeps the page off the front site."""
    return F.expr(f"exists({tokens}, t -> t.kind = 'start' AND {front_hidden('t')})")


def description(tokens: str) -> Column:
    """Text of the first paragraph that has any and is not databox lines; else empty."""
    text_of = let("x", _plain_text(_inside(tokens, "p")), r"if(contains(x, ';\n'), '', x)")
    # Later paragraphs are not read once one has been found.
    found = f"""aggregate({_elements(tokens, lambda t: is_start(t, 'p'))}, '',
                          (found, p) -> CASE WHEN found <> '' THEN found ELSE {text_of} END)"""
    return F.expr(strip_sql(found))


def byline_names(tokens: str) -> Column:
    """First child of every link in the byline, as written."""
    bylines = _elements(tokens, lambda t: f"{is_start(t, 'div')} AND {t}.attrs['id'] = 'authorByline'")
    links = f"""flatten(transform({bylines}, b -> filter({_inside(tokens, 'b')},
                                                       t -> {is_start('t', 'a')} AND t.last > t.pos + 1)))"""
    child = f"get({tokens}, link.pos + 1)"
    whole = _slice(tokens, "child.pos", "child.last + 1")
    first = let("child", child, f"CASE WHEN child.kind = 'text' THEN child.text ELSE {_render(whole)} END")
    return F.expr(f"transform({links}, link -> {first})")


def citation_texts(tokens: str) -> str:
    """First text of each citation div, as SQL."""
    divs = _elements(tokens, lambda t: f"{is_start(t, 'div')} AND {t}.attrs['id'] = 'citationAuthor'")
    first = f"filter({_slice(tokens, 'd.pos + 1', 'd.pos + 2')}, t -> t.kind = 'text')"
    return f"flatten(transform({divs}, d -> transform({first}, t -> t.text)))"


# --- databoxes ------------------------------------------------------------------------------


def _databox_rows(text: str) -> str:
    """`Key:value` lines to rows; a value with semicolons also as its trimmed, non-empty parts.

    Keys are lower-cased and one that occurs twice keeps its first place and its last value.
    """
    lines = f"filter(transform(split({text}, '\\n'), line -> {strip_sql('line')}), line -> contains(line, ':'))"
    parts = f"filter(transform(split(pair[1], ';'), part -> {strip_sql('part')}), part -> part <> '')"
    rows = f"""transform(transform({lines}, line -> split(line, ':', 2)), pair -> named_struct(
                 'key', lower(pair[0]), 'raw', pair[1], 'parts', if(contains(pair[1], ';'), {parts}, NULL)))"""
    last_of_each = "transform(array_distinct(rows.key), k -> element_at(filter(rows, r -> r.key = k), -1))"
    return let("rows", rows, last_of_each)


def _databox_texts(tokens: str, ids=None) -> str:
    if ids:
        first = _elements(tokens, lambda t: f"{is_start(t)} AND {t}.attrs['id'] = id")
        names = ", ".join(literal(i) for i in ids)
        found = f"flatten(transform(array({names}), id -> slice({first}, 1, 1)))"
    else:
        found = _elements(
            tokens,
            lambda t: f"{is_start(t, 'div')} AND contains({t}.attrs['id'], 'databox') AND {t}.attrs['style'] = 'display:none;'",
        )
    paragraph = f"try_element_at({_elements('body', lambda t: is_start(t, 'p'))}, 1)"
    text = let("body", _inside(tokens, "box"), let("p", paragraph, f"if(p IS NULL, NULL, {_render(_inside('body', 'p', 'body[0].pos'))})"))
    return f"transform({found}, box -> named_struct('databox', box.attrs['id'], 'text', {text}))"


def databox_texts(tokens: str, ids=None) -> Column:
    """Databoxes of a page: array<struct<databox, text>>, in the order of `ids` or of the page.

    With `ids`, the first element of each id; without, every hidden div whose id names a databox.
    The text is the markup inside the first paragraph, null if there is no paragraph.
    """
    return F.expr(_databox_texts(tokens, ids))


def databoxes(tokens: str, ids=None) -> Column:
    """Databoxes of a page: array<struct<databox, rows>> as told for `databox_texts`."""
    rows = _databox_rows("coalesce(b.text, '')")
    return F.expr(f"transform({_databox_texts(tokens, ids)}, b -> named_struct('databox', b.databox, 'rows', {rows}))")


# --- links ----------------------------------------------------------------------------------

# The classes that mark what a link points at.
LINK_CLASSES = ["offsite", "encyc", "rg", "notrg"]


def _link_title(href: str, base: str) -> str:
    title = f"regexp_replace({href}, '/$', '')"
    if base:
        title = f"replace({title}, {literal(base)}, '')"
    return let("title", f"regexp_replace({title}, '^/', '')", "if(contains(title, 'http'), '', title)")


def _link_marks(href: str, in_guide: str) -> str:
    return f"""CASE WHEN startswith({href}, '#') OR contains({href}, 'File') THEN cast(array() AS array<string>)
                    WHEN contains({href}, 'http:') OR contains({href}, 'https:') THEN array('offsite')
                    WHEN {in_guide} THEN array('encyc', 'rg') ELSE array('encyc', 'notrg') END"""


def _rewritten(href: str) -> str:
    plain = f"replace(replace(replace({href}, '?title=', '/'), '&action=edit', ''), '&redlink=1', '')"
    link = f"if(contains({href}, 'action=edit'), {plain}, {href})"
    for name in ("pagefrom", "pageuntil"):
        kept = f"replace(replace(link, '?title=', '/'), '&{name}=', '?{name}=')"
        link = let("link", link, f"if(contains(link, '{name}='), {kept}, link)")
    return link


def link_title(href: str, base: str) -> Column:
    """Title of the page that a link names; empty for a link that holds `http`."""
    return F.expr(_link_title(href, base))


def link_marks(href: str, in_guide: str) -> Column:
    """Marker classes of a link, given whether its title is in the resource guide."""
    return F.expr(_link_marks(href, in_guide))


def rewrite_href(href: str) -> Column:
    """Links that would create a page lead to the page itself; links that page through a listing
    keep only that parameter.
    """
    return F.expr(_rewritten(href))


def _written(value: str) -> str:
    """An attribute value escaped and quoted."""
    escaped = f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    both = """concat('"', replace(v, '"', '&quot;'), '"')"""
    return let(
        "v",
        escaped,
        f"""CASE WHEN contains(v, '"') AND contains(v, "'") THEN {both}
                 WHEN contains(v, '"') THEN concat("'", v, "'") ELSE concat('"', v, '"') END""",
    )


def mark_links(tokens: str, base: str, guide: str) -> Column:
    """Set the marker classes of every link and rewrite new-page and paging links.

    `guide` names an array of the resource guide's titles, or at least those the page links to.
    A link without an href is left as it is.
    """
    href = "t.attrs['href']"
    known = f"name <> '' AND (array_contains({guide}, name) OR array_contains({guide}, translate(name, '_', ' ')))"
    ours = ", ".join(literal(c) for c in LINK_CLASSES)
    classes = f"concat(filter(t.classes, c -> c NOT IN ({ours})), {_link_marks(href, let('name', _link_title(href, base), known))})"
    changed = f"""transform(map_entries(t.attrs), e -> named_struct('key', e.key, 'value',
                    CASE e.key WHEN 'href' THEN {_rewritten(href)} WHEN 'class' THEN array_join(classes, ' ') ELSE e.value END))"""
    added = "array(named_struct('key', 'class', 'value', array_join(classes, ' ')))"
    attrs = f"if(map_contains_key(t.attrs, 'class'), {changed}, concat({changed}, {added}))"
    raw = f"concat('<a', array_join(transform(attrs, e -> concat(' ', e.key, '=', {_written('e.value')})), ''), '>')"
    rebuilt = f"""named_struct('pos', t.pos, 'kind', t.kind, 'tag', t.tag, 'attrs', map_from_entries(attrs), 'classes', classes,
                               'raw', {raw}, 'text', t.text, 'last', t.last, 'parent', t.parent)"""
    marked = let("classes", classes, let("attrs", attrs, rebuilt))
    return F.expr(f"transform({tokens}, t -> CASE WHEN {is_start('t', 'a')} AND {href} IS NOT NULL THEN {marked} ELSE t END)")


def _piece(kind: str, raw: str) -> str:
    """A token of its own that is no element and nothing else has to do with."""
    return f"""named_struct('pos', -1, 'kind', '{kind}', 'tag', cast(NULL AS string), 'attrs', cast(NULL AS map<string, string>),
                            'classes', cast(NULL AS array<string>), 'raw', {raw}, 'text', cast(NULL AS string), 'last', -1, 'parent', -1)"""


def _rewrite(t: str, raw: str) -> str:
    """A token with other markup."""
    return f"""named_struct('pos', {t}.pos, 'kind', {t}.kind, 'tag', {t}.tag, 'attrs', {t}.attrs, 'classes', {t}.classes,
                            'raw', {raw}, 'text', {t}.text, 'last', {t}.last, 'parent', {t}.parent)"""


def _at(tokens: str, places: str, changed: str) -> str:
    """Tokens with those at `places` (an array of rising positions) changed; `changed` says how, of token `t`."""
    following = f"coalesce(get(places, i + 1), size({tokens}))"
    parts = f"""transform(places, (p, i) -> concat(transform({_slice(tokens, 'p', 'p + 1')}, t -> {changed}), {_slice(tokens, 'p + 1', following)}))"""
    return let("places", places, f"if(size(places) = 0, {tokens}, concat({_slice(tokens, '0', 'places[0]')}, flatten({parts})))")


# --- removing elements ----------------------------------------------------------------------

# What is left of a removed token: it keeps its place in the array.
GONE = "gone"


def _spans(tokens: str, *tests) -> str:
    """Places of the outermost of the elements that pass one of the tests, in order."""
    chosen = " OR ".join(f"coalesce({test('t')}, false)" for test in tests)
    all_ = f"transform(filter({tokens}, t -> t.kind = 'start' AND ({chosen})), t -> named_struct('pos', t.pos, 'last', t.last))"
    # One sweep with the end of the current span as state.
    start = "named_struct('end', -1, 'kept', cast(array() AS array<struct<pos: int, last: int>>))"
    sweep = f"aggregate({all_}, {start}, (found, s) -> if(s.last <= found.end, found, named_struct('end', s.last, 'kept', array_append(found.kept, s))))"
    return f"{sweep}.kept"


def _without(tokens: str, spans: str, note: str | None = None) -> str:
    """Tokens with nothing, or with `note`, where the spans were."""
    nothing = f"array_repeat({_piece(GONE, literal(''))}, s.last - s.pos{' + 1' if note is None else ''})"
    instead = nothing if note is None else f"concat(array({_piece(OTHER, note)}), {nothing})"
    following = f"coalesce(get(gone, i + 1).pos, size({tokens}))"
    parts = f"transform(gone, (s, i) -> concat({instead}, {_slice(tokens, 's.last + 1', following)}))"
    return let("gone", spans, f"if(size(gone) = 0, {tokens}, concat({_slice(tokens, '0', 'gone[0].pos')}, flatten({parts})))")


def drop(tokens: str, *tests) -> Column:
    """Tokens less every element that passes one of the tests, with all it holds; what is gone leaves empty tokens."""
    return F.expr(_without(tokens, _spans(tokens, *tests)))


def empty_paragraph(tokens: str):
    """Test for paragraphs written exactly as `<p><br />`, line break, `</p>`; needs whole tokens."""

    def test(t: str) -> str:
        br, text = f"get({tokens}, {t}.pos + 1)", f"get({tokens}, {t}.pos + 2)"
        return (
            f"{t}.tag = 'p' AND {t}.text = '<p>' AND {t}.last = {t}.pos + 3 AND {br}.kind = 'start' "
            f"AND {br}.text = '<br />' AND {text}.kind = 'text' AND {text}.text = '\\n'"
        )

    return test


def page_title(t: str) -> str:
    return f"{t}.tag = 'h1'"


def edit_link(t: str) -> str:
    return f"{t}.tag = 'span' AND {has_class(t, 'mw-editsection')}"


def status_marker(t: str) -> str:
    return f"{t}.tag = 'div' AND {has_class(t, 'alert')} AND array_contains({t}.classes, 'published')"


# Fixed value: the class of what is kept off the front site.
FRONT_HIDDEN = "nopublish-encycfront"


def front_hidden(t: str) -> str:
    return f"{t}.tag = 'div' AND {has_class(t, FRONT_HIDDEN)}"


def upload_link(t: str) -> str:
    return f"{t}.tag = 'a' AND {has_class(t, 'new')}"


def source_image(tokens: str, source_ids: str):
    """Test for image links whose picture is one of the page's own media sources."""

    def test(t: str) -> str:
        image = f"try_element_at(filter({_inside(tokens, t)}, i -> {is_start('i', 'img')}), 1)"
        named = let("src", f"{image}.attrs['src']", let("name", _image_id("src"), f"name <> '' AND array_contains({source_ids}, name)"))
        return f"{t}.tag = 'a' AND {has_class(t, 'image')} AND size({source_ids}) > 0 AND {named}"

    return test


def hide_tags(tokens: str, selector: str, comments: bool = True) -> Column:
    """Elements that match `attribute=value` give way to a comment, or to nothing."""
    attr, value = selector.split("=")

    def chosen(t: str) -> str:
        return has_class(t, value) if attr == "class" else f"{t}.attrs[{literal(attr)}] = {literal(value)}"

    if not comments:
        return drop(tokens, chosen)
    return F.expr(_without(tokens, _spans(tokens, chosen), literal(f'<!--"{value}" removed-->')))


# --- sections and top links -----------------------------------------------------------------

HEADERS = ["h2", "h3", "h4"]

# Fixed value: the link back to the top of a page.
TOP_LINK = '<div class="toplink"><a href="#top"><i class="icon-chevron-up"></i> Top</a></div>'

_END_OF_PAGE = 2147483647


def section_bounds(tokens: str) -> Column:
    """Sections: array<struct<start, header_end, stop, id>> by token position.

    A section is a header that holds a headline, and what follows it under the same parent up
    to the next header or the parent's end.
    """
    headlines = _elements(tokens, lambda t: f"{is_start(t, 'span')} AND {has_class(t, 'mw-headline')} AND {t}.parent >= 0")
    parents = f"array_sort(array_distinct(transform({headlines}, t -> t.parent)))"
    headers = f"filter(transform({parents}, p -> get({tokens}, p)), t -> t.kind = 'start')"
    span = f"try_element_at(filter({_inside(tokens, 'h')}, t -> {is_start('t', 'span')}), 1)"
    following = "filter(heads, t -> t.parent = h.parent AND t.pos > h.last)"
    outer = f"if(h.parent < 0, NULL, get({tokens}, h.parent))"
    stop = f"coalesce(try_element_at({following}, 1).pos, {outer}.last, {_END_OF_PAGE})"
    bounds = f"""transform({headers}, h -> named_struct('start', h.pos, 'header_end', h.last, 'stop', {stop},
                                                        'id', coalesce({span}.attrs['id'], '')))"""
    heads = f"transform({_elements(tokens, lambda t: is_start(t, *HEADERS))}, t -> named_struct('pos', t.pos, 'parent', t.parent))"
    return F.expr(let("heads", heads, bounds))


def wrap_sections(tokens: str, bounds: str) -> Column:
    """Put every section into a div, and what follows its header into a content div."""
    opening = f"""concat('<div class="section" id=', {_written('b.id')}, '>')"""
    closing, content = literal("</div></div>"), literal('<div class="section_content">')
    closings = f"repeat({closing}, size(filter({bounds}, b -> b.stop = t.pos)))"
    openings = f"array_join(transform(filter({bounds}, b -> b.start = t.pos), b -> {opening}), '')"
    contents = f"repeat({content}, size(filter({bounds}, b -> b.header_end = t.pos)))"
    edges = f"flatten(transform({bounds}, b -> array(b.start, b.header_end, b.stop)))"
    places = f"array_sort(array_distinct(filter({edges}, p -> p < {_END_OF_PAGE})))"
    wrapped = _at(tokens, places, _rewrite("t", f"concat({closings}, {openings}, t.raw, {contents})"))
    ending = f"transform(filter({bounds}, b -> b.stop = {_END_OF_PAGE}), b -> {_piece(OTHER, closing)})"
    return F.expr(f"if(size({bounds}) = 0, {tokens}, concat({wrapped}, {ending}))")


def add_top_links(tokens: str) -> Column:
    """A link to the top before the third and every later h2, and one at the end."""
    places = f"filter(transform({_elements(tokens, lambda t: is_start(t, 'h2'))}, t -> t.pos), (pos, i) -> i >= 2)"
    linked = _at(tokens, places, _rewrite("t", f"concat({literal(TOP_LINK)}, t.raw)"))
    return F.expr(f"concat({linked}, array({_piece(OTHER, literal(TOP_LINK))}))")


# --- finished text --------------------------------------------------------------------------


def strip_wiki_paths(html) -> Column:
    """Remove the wiki's script path, then its base path, wherever they occur."""
    return F.regexp_replace(F.regexp_replace(col(html), "/mediawiki/index.php", ""), "/mediawiki", "")


def strip_bare_tags(html) -> Column:
    return F.regexp_replace(col(html), "</?(html|body)>", "")
