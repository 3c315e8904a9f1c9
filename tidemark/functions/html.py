"""A small helper around ``html.parser`` that finds elements by tag, class, descendant and child selectors."""

from __future__ import annotations

from html.parser import HTMLParser

# Elements without an end tag.
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def parse_selector(selector: str) -> list[tuple[str, bool, str, frozenset[str]]]:
    """Steps ``(text, is_child, tag, classes)`` of a selector such as ``tr.athing span > a``."""
    steps, child = [], False
    for part in selector.replace(">", " > ").split():
        if part == ">":
            child = True
            continue
        tag, *classes = part.split(".")
        steps.append((part, child, tag, frozenset(classes)))
        child = False
    return steps


def _step_fits(step, element) -> bool:
    return (not step[2] or step[2] == element[0]) and step[3] <= element[1]


def _path_fits(steps, path) -> bool:
    """Whether the last element of ``path`` (root first) is selected."""
    if not steps or not path or not _step_fits(steps[-1], path[-1]):
        return False
    if len(steps) == 1:
        return True
    parents = path[:-1]
    if steps[-1][1]:
        return _path_fits(steps[:-1], parents)
    return any(_path_fits(steps[:-1], parents[: end + 1]) for end in range(len(parents)))


class _RowReader(HTMLParser):
    def __init__(self, row_selector: str, fields: dict[str, tuple[str, str | None]]):
        super().__init__(convert_charrefs=True)
        self.row_steps = parse_selector(row_selector)
        self.fields = {name: (parse_selector(selector), attribute) for name, (selector, attribute) in fields.items()}
        self.path: list[tuple[str, frozenset[str]]] = []
        self.rows: list[dict[str, str]] = []
        self.open_rows: list[tuple[int, dict[str, str]]] = []
        self.captures: list[tuple[int, dict[str, str], str]] = []

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        self.path.append((tag, frozenset((attributes.get("class") or "").split())))
        depth = len(self.path)
        for row_depth, row in self.open_rows:
            for name, (steps, attribute) in self.fields.items():
                if name not in row and _path_fits(steps, self.path[row_depth:]):
                    row[name] = (attributes.get(attribute) or "") if attribute else ""
                    if not attribute:
                        self.captures.append((depth, row, name))
        if _path_fits(self.row_steps, self.path):
            row = {}
            self.rows.append(row)
            self.open_rows.append((depth, row))
        if tag in VOID_TAGS:
            self._close_to(depth - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close_to(len(self.path) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self.path), 0, -1):
            if self.path[depth - 1][0] == tag:
                self._close_to(depth - 1)
                return

    def handle_data(self, data):
        for _, row, name in self.captures:
            row[name] += data

    def _close_to(self, depth: int):
        del self.path[depth:]
        self.open_rows = [entry for entry in self.open_rows if entry[0] <= depth]
        self.captures = [entry for entry in self.captures if entry[0] <= depth]


def rows_of(html: str, row_selector: str, fields: dict[str, tuple[str, str | None]]) -> list[dict[str, str]]:
    """For each selected row element the first match of every field: its text, or the named attribute."""
    reader = _RowReader(row_selector, fields)
    reader.feed(html or "")
    reader.close()
    return reader.rows
