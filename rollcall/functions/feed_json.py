"""Small helper that reads one JSON feed document strictly."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring


def read_feed(body: str | None) -> dict:
    """``{reason, groups}``: the groups in document order, or why the document is set aside.

    A document is one JSON object and nothing else; each value is a list of texts. A repeated group keeps
    its first place and its last list.
    """
    try:
        feed = json.loads(body)
    except (TypeError, ValueError, RecursionError):
        return {"reason": "invalid json", "groups": None}
    if not isinstance(feed, dict) or not all(isinstance(names, list) for names in feed.values()):
        return {"reason": "not an object of lists", "groups": None}
    if not all(isinstance(name, str) for names in feed.values() for name in names):
        return {"reason": "a name that is no text", "groups": None}
    groups = [{"league": group, "names": names} for group, names in feed.items()]
    try:
        json.dumps(feed, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return {"reason": "half a character", "groups": None}
    return {"reason": None, "groups": groups}


SPACE = re.compile(r"[ \t\n\r]*")


def read_element(text: str) -> tuple:
    """``(bad, key, value, opens, closes, ends)`` of what stands between two commas of a document.

    That is a text, in front of it what opens the document and its list, behind it what closes them; an empty list
    has its key and no text, an empty document neither.
    """
    at, key, value, flags = 0, None, None, {}

    def taken(sign: str) -> bool:
        nonlocal at
        at = SPACE.match(text, at).end()
        if not text.startswith(sign, at):
            return False
        at += 1
        return True

    try:
        flags["{"] = taken("{")
        if taken('"'):
            value, at = scanstring(text, at, True)
            if taken(":"):
                key, value = value, None
                if not taken("["):
                    raise ValueError("no list")
                if taken('"'):
                    value, at = scanstring(text, at, True)
        flags["]"], flags["}"] = taken("]"), taken("}")
        ((key or "") + (value or "")).encode()
    except ValueError:  # half a character, too
        return True, None, None, False, False, False
    at = SPACE.match(text, at).end()
    opens, closes, ends = flags["{"], flags["]"], flags["}"]
    bare = opens and ends and key is None and value is None and not closes
    bad = at < len(text) or (ends and not closes and not bare) or (opens and key is None and not bare)
    bad = bad or (value is None and not bare and not (key is not None and closes))
    return bad, key, value, opens, closes, ends
