"""Plain-Python version of the secret scan, written from its description."""

import math
import re

from churnframe.llm import secrets_scan as ss

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8 and m[1].isascii()]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out)


def spans(text):
    text = text or ""
    b = base(text)
    extra = set()
    for cls in ss.CLASSES:
        for m in re.finditer(cls.alphabet + "+", text):
            run = m[0]
            if (len(run) < cls.width or not re.search(cls.must, run) or any(re.search(p, run) for p in ss.ALLOW)
                    or any(s < m.end() and m.start() < e for s, _, e in b)):
                continue
            hits = []
            for i in range(len(run) - cls.width + 1):
                win = run[i:i + cls.width]
                h = -sum(win.count(c) / cls.width * math.log2(win.count(c) / cls.width) for c in set(win))
                if h >= cls.bits - 1e-6:
                    hits.append(i)
            if hits:
                extra.add((m.start() + hits[0], 3, m.start() + hits[-1] + cls.width))
    return b, sorted(set(b) | extra)
