"""A scanner of markup that goes through a page once, forwards, whatever the page holds."""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle

# Tasks get these functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SIGN = re.compile(r"""[>"']""")
# Most tags: quotes stand behind an equals sign and are closed. What this does not match takes the long way.
_PLAIN = re.compile(r"""<(/?)([A-Za-z][^\s/>"'=<]*+)(?=[\s/>])((?:[^"'<>=]++|="[^"]*+"|='[^']*+'|=(?![\s"']))*+)>""")
_MISSES = 200  # tags that may take the long way after the short one was tried; so many passes over a page at most
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}


class _Tags:
    """Ends of tags: a ``>`` in a quoted value is part of it, unless the quote is never closed."""

    def __init__(self, page: str):
        self.page, self.last, self.unquoted_until = page, page.rfind(">"), 0

    def end(self, begin: int) -> int:
        """Place of the ``>`` of the tag that begins there, -1 if there is none."""
        if begin > self.last:
            return -1
        at = begin
        while begin >= self.unquoted_until:
            found = _SIGN.search(self.page, at)
            if found is None:
                self.unquoted_until = len(self.page)
            elif found[0] == ">":
                return found.start()
            elif self.page[max(begin, found.start() - 64):found.start()].rstrip()[-1:] != "=":
                at = found.end()
            else:
                closed = self.page.find(found[0], found.end())
                if closed < 0:
                    self.unquoted_until = len(self.page)  # every tag up to here would run into the same quote
                at = closed + 1
        return self.page.find(">", begin)


def scan(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """``(text before, tag, is end, attributes)`` in order; the tag is empty for what is no element.

    The content of scripts and the like is left out. A tag that never ends is text.
    """
    at, begin, tags, misses = 0, page.find("<"), _Tags(page), 0

    def text(end: int) -> str:
        found = page[at:end]
        return entities.unescape(found) if "&" in found else found

    while 0 <= begin < len(page):
        if misses < _MISSES and begin <= tags.last and not tags.unquoted_until:
            if plain := _PLAIN.match(page, begin):
                is_end, tag, attributes = plain.groups()
                tag = tag.lower()
                before = page[at:begin]
                yield entities.unescape(before) if "&" in before else before, tag, is_end != "", attributes
                at = plain.end()
                if tag in _RAW_END and not is_end:
                    closed = _RAW_END[tag].search(page, at - 1)
                    at = len(page) if closed is None else closed.start()
                begin = page.find("<", at)
                continue
            misses += page[begin + 1:begin + 2] not in "!? "
        after = page[begin + 1:begin + 2]
        if after in ("!", "?") and after:
            close = "-->" if page.startswith("<!--", begin) else ">"
            end = page.find(close, begin + 4 if close == "-->" else begin)
            yield text(begin), "", False, ""
            at = len(page) if end < 0 else end + len(close)
        else:
            name = _NAME.match(page, begin + 2 if after == "/" else begin + 1)
            end = tags.end(begin) if name else -1
            if end < 0:
                begin = page.find("<", begin + 1)
                continue
            tag = name[0][:end - name.start()].lower()
            yield text(begin), tag, after == "/", page[min(end, name.end()):end]
            at = end + 1
            if after != "/" and tag in _RAW_END:
                closed = _RAW_END[tag].search(page, end)
                at = len(page) if closed is None else closed.start()
        begin = page.find("<", at)
    yield text(len(page)), "", False, ""
