"""Plain re-statements of the operators' definitions, for small inputs."""

import re

from tallygate.llm import secret_scan


def deleted_lines(rows, lines, words):
    """Per row, the numbers of the lines that lie in a window seen earlier."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    seen, gone = set(), [set() for _ in rows]
    for r in order:
        entries = [(i, x) for i, x in enumerate((rows[r][1] or "").split("\n")) if x.replace(" ", "")]
        for k in range(len(entries)):
            window, total = [], 0
            for i, x in entries[k:]:
                window.append((i, x))
                total += x.count(" ") + 1
                if total >= words or len(window) == lines:
                    break
            else:
                continue
            content = tuple(x for _, x in window)
            if content in seen:
                gone[r].update(i for i, _ in window)
            seen.add(content)
    return gone


def linked_spans(text, scope):
    """(kind, start, end) by start, then kind: base spans, and weak ones with their complements."""
    names = [k for k, *_ in secret_scan.KINDS]
    base = {
        "assign": (r"(?a:((?i:password|passwd|[s]ecret|to[k]en|api_?[k]ey))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+))", 2, 6),
        "access": (r"AKIA[A-Z0-9]+", 0, 20),
        "hex": (r"[0-9a-f]+", 0, 24),
    }
    found = []
    for name, pattern, group, least in secret_scan.KINDS:
        pattern, group, least = base.get(name, (pattern, group, least))
        for m in re.finditer(pattern, text):
            if name == "assign" and not m.group(1).isascii():
                continue
            if len(m.group(group)) >= least:
                found.append((name, *m.span()))

    def near(part, roles):
        return any(secret_scan._ROLE[k] in roles and s <= part[2] + scope and e >= part[1] - scope
                   for k, s, e in found)

    def whole(part):
        kind = part[0]
        if kind == "ident":
            return near(part, {"secret"})
        if kind == "weak":
            return near(part, {"ident"}) or near(part, {"endpoint"})
        if kind == "endpoint":
            return near(part, {"ident"}) and near(part, {"secret"})
        return True

    return sorted((p for p in found if whole(p)), key=lambda p: (p[1], names.index(p[0])))
