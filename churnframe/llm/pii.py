"""Operator 4, personal data by weak supervision.

Base kinds (email, ip, card, phone) are fixed patterns and always kept.
Looser candidates (spelled-out emails, local phone numbers, identity numbers,
bank accounts, names after a title) are judged by labelers that vote for,
against, or abstain: patterns, gazetteers and context words.  The votes of all
candidates of all documents, base spans included, are counted per vote
pattern; expectation-maximisation over those counts estimates each labeler's
reliability and each pattern's probability.  A span classifier (logistic
regression on discrete span features) is trained on the probabilities of all
candidates, again from counts, and decides which candidates become spans.

Only tables of bounded size reach the driver: at most ``3 ** labelers`` vote
patterns and one row per combination of feature values.  Texts are read once.

Positions are code points, end exclusive.  Defined results: null or empty text
has no spans; very long texts are scanned whole in linear time; repeated rows
get equal results; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import materialize_as

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_spelled", "phone_local", "id_number", "bank_account", "name")

# fixed values of the base patterns; digit runs are taken whole, so no match
# starts inside a run
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# looser candidates; every repetition is bounded or anchored on a rare start
_SPELLED = re.compile(r"(?<![\w.])[A-Za-z0-9._-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}"
                      r"(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}){1,4}")
_LOCAL_PHONE = re.compile(r"(?<![\w.+-])\(?0?[0-9]{2,4}\)?[ ./-][0-9]{3,4}(?:[ .-][0-9]{2,4}){1,2}(?![\w-])")
_ID = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra")
_NAME = re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.? ((?:[^\W\d_a-z][^\W\d_]{1,30})(?: [^\W\d_a-z][^\W\d_]{1,30}){0,2})")

# gazetteers and context words of the labelers
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48",
                 "49", "52", "54", "55", "61", "81", "82", "86", "91", "351", "353", "358")
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "it", "info")
FOR_WORDS = re.compile(r"\b(?:e-?mail|mail|contact|call|phone|tel|mobile|fax|kontakt|telefon|teléfono|correo|courriel|"
                       r"ssn|social security|id|iban|account|konto|card|visa|name|named|signed|dear|ip|address)\b", re.I)
AGAINST_WORDS = re.compile(r"\b(?:version|isbn|page|figure|fig|table|chapter|section|price|total|order|invoice|rfc|"
                           r"street|road|lake|mount)\b|[$€£#]\s*$", re.I)
CONTEXT = 40
LABELERS = ("shape", "checksum", "gazetteer", "for_word", "against_word", "boundary", "variety")
EM_ROUNDS = 40
ACCEPT = 0.5


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found outward from each ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            s = at
            while s > done and text[s - 1] in _LOCAL:
                s -= 1
            if s < at:
                yield s, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) sorted by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    if any(d in text for d in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g[-3:]) <= 255 for g in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(ch.isdigit() for ch in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the added kinds that meet no base span."""
    found = []
    if "at]" in text or "at)" in text:
        found += [(m.start(), 4, m.end()) for m in _SPELLED.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(m.start(), 5, m.end()) for m in _LOCAL_PHONE.finditer(text)]
        found += [(m.start(), 6, m.end()) for m in _ID.finditer(text)]
        found += [(m.start(), 7, m.end()) for m in _IBAN.finditer(text)]
    found += [(m.start(1), 8, m.end(1)) for m in _NAME.finditer(text)]
    out, ends, k = [], 0, 0
    for s, kind, e in sorted(found):
        while k < len(taken) and taken[k][2] <= s:
            k += 1
        if s >= ends and not (k < len(taken) and taken[k][0] < e):
            out.append((s, kind, e))
            ends = e
    return out


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, start: int, kind: int, end: int) -> str:
    """One character per labeler: ``+`` for, ``-`` against, ``0`` abstains."""
    s = text[start:end][:256]
    digits = [c for c in s if c.isdigit()]
    before = text[max(0, start - CONTEXT):start]
    name = KINDS[kind]
    v = dict.fromkeys(LABELERS, "0")
    if name in ("email", "email_spelled"):
        v["shape"] = "+" if any(c.isalpha() for c in s) else "-"
        v["gazetteer"] = "+" if s.lower().rpartition(".")[2].strip() in TOP_DOMAINS else "0"
    elif name == "ip":
        parts = s.split(".")
        v["shape"] = "-" if any(len(p) > 1 and p[0] == "0" for p in parts) else "+"
        v["gazetteer"] = "-" if parts[0] in ("0", "127", "255") else "+"
    elif name == "card":
        v["checksum"] = "+"
        v["gazetteer"] = "+" if s[0] in "3456" else "-"
    elif name == "phone":
        v["gazetteer"] = "+" if re.sub(r"\D", " ", s[1:]).split()[0][:3].startswith(CALLING_CODES) else "-"
        v["shape"] = "+"
    elif name == "phone_local":
        v["shape"] = "+" if 9 <= len(digits) <= 11 else "-"
        v["gazetteer"] = "+" if s.startswith(("0", "(")) else "0"
    elif name == "id_number":
        v["checksum"] = "-" if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" else "+"
    elif name == "bank_account":
        v["checksum"] = "+" if _iban_ok(s) else "-"
    else:
        v["shape"] = "+" if " " in s else "0"
        v["gazetteer"] = "+"
    v["for_word"] = "+" if FOR_WORDS.search(before) else "0"
    v["against_word"] = "-" if AGAINST_WORDS.search(before) else "0"
    edge = text[start - 1:start] + text[end:end + 1]
    v["boundary"] = "-" if any(c.isalnum() for c in edge) else "+"
    if digits:
        v["variety"] = "-" if len(set(digits)) <= 2 else "+"
    return "".join(v[x] for x in LABELERS)


def span_features(text: str, start: int, kind: int, end: int) -> str:
    """Discrete features of a span, without the labelers' votes."""
    s = text[start:end]
    n = end - start
    digits = sum(c.isdigit() for c in s)
    sep = "s" if " " in s else "p" if any(c in ".-()/" for c in s) else "n"
    prev = text[start - 1:start]
    where = "b" if not prev else "s" if prev.isspace() else "a" if prev.isalnum() else "o"
    return f"{kind}|{min(n // 8, 6)}|{min(4 * digits // max(n, 1), 4)}|{sep}|{where}|{int(any(c.isupper() for c in s))}"


_CANDIDATE = "array<struct<start:int,kind:int,end:int,base:boolean,votes:string,feats:string>>"


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus ``spans``: every candidate of each row."""
    carry = [c for c in df.columns if c != text]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_()), ("votes", pa.string()), ("feats", pa.string())]))

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            t = t.as_py() or ""
            base = base_spans(t)
            rows.append([{"start": s, "kind": k, "end": e, "base": is_base, "votes": votes(t, s, k, e),
                          "feats": span_features(t, s, k, e)}
                         for is_base, group in ((True, base), (False, loose_spans(t, base))) for s, k, e in group])
        return pa.array(rows, kind)

    udf = F.arrow_udf(run, _CANDIDATE)
    return df.select(*carry, udf(F.coalesce(F.col(text), F.lit(""))).alias("spans"))


def em(patterns: list[str], counts: np.ndarray, known: np.ndarray | None = None,
       rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Two-class model of independent labelers over vote patterns: returns the
    probability of each pattern and (2, labelers, 3) vote rates, for class
    "not personal" and "personal" and votes -, 0, +.  ``known`` marks patterns
    of spans that are personal for certain (the base kinds)."""
    x = np.array([["-0+".index(c) for c in p] for p in patterns])
    hot = (x[:, :, None] == np.arange(3)).astype(float)  # (patterns, labelers, 3)
    known = np.zeros(len(patterns), bool) if known is None else known
    q = np.clip(0.5 + 0.2 * (x - 1).sum(axis=1), 0.05, 0.95)  # start: majority vote
    q[known] = 0.99
    # a weak belief that labelers are better than chance names the classes
    belief = (1 + 0.01 * counts.sum()) * np.array([[0.4, 0.5, 0.1], [0.1, 0.5, 0.4]])
    rates = np.zeros((2, x.shape[1], 3))
    for _ in range(rounds):
        for c, weight in ((0, counts * (1 - q)), (1, counts * q)):
            got = np.einsum("p,plv->lv", weight, hot) + belief[c]
            rates[c] = got / got.sum(axis=1, keepdims=True)
        free = counts * ~known
        prior = np.clip(((free * q).sum() + 1) / (free.sum() + 2), 0.05, 0.95)
        log = np.einsum("plv,clv->pc", hot, np.log(rates))
        q = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1] + np.log((1 - prior) / prior), -50, 50)))
        q[known] = 0.99
    return q, rates


def fit_classifier(feats: list[str], yes: np.ndarray, no: np.ndarray, steps: int = 400) -> dict[str, float]:
    """Logistic regression on the parts of the feature strings, weighted by
    the expected numbers of personal and other spans; returns the probability
    of every feature combination."""
    parts = [[f"{i}={p}" for i, p in enumerate(f.split("|"))] for f in feats]
    index = {p: i for i, p in enumerate(sorted({p for ps in parts for p in ps}))}
    x = np.zeros((len(feats), len(index) + 1))
    x[:, -1] = 1
    for r, ps in enumerate(parts):
        x[r, [index[p] for p in ps]] = 1
    w = np.zeros(x.shape[1])
    total = (yes + no).sum()
    for _ in range(steps):  # Newton steps damped by a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((yes + no) * p - yes) / total + 1e-4 * w
        h = (x * ((yes + no) * p * (1 - p) / total)[:, None]).T @ x + 1e-4 * np.eye(len(w))
        move = np.linalg.solve(h, g)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return dict(zip(feats, 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))))


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus ``base_spans`` and ``all_spans``: arrays
    of (start, kind, end) sorted by start, then kind; ``kind`` indexes
    ``KINDS``."""
    found = materialize_as(candidates(df, text), "pii-candidates")
    seen = (found.filter(F.size("spans") > 0).select(F.explode_outer("spans").alias("s"))
                 .groupBy("s.base", "s.votes", "s.feats").agg(F.count(F.lit(1)).alias("n")).collect())
    accepted: list[str] = []
    if seen:
        seen.sort()
        total = Counter()
        for r in seen:
            total[r["base"], r["votes"]] += r["n"]
        patterns = sorted(total)
        q, _ = em([p for _, p in patterns], np.array([total[p] for p in patterns], float),
                  np.array([base for base, _ in patterns]))
        posterior = dict(zip(patterns, q))
        feats = sorted({r["feats"] for r in seen})
        yes, no = dict.fromkeys(feats, 0.0), dict.fromkeys(feats, 0.0)
        for r in seen:
            yes[r["feats"]] += r["n"] * posterior[r["base"], r["votes"]]
            no[r["feats"]] += r["n"] * (1 - posterior[r["base"], r["votes"]])
        prob = fit_classifier(feats, np.array([yes[f] for f in feats]), np.array([no[f] for f in feats]))
        accepted = [f for f in feats if prob[f] >= ACCEPT]
    plain = lambda a: F.sort_array(F.transform(a, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    good = lambda s: s["base"] | (s["feats"].isin(accepted) if accepted else F.lit(False))
    return found.select(*[c for c in df.columns if c != text],
                        plain(F.filter("spans", lambda s: s["base"])).alias("base_spans"),
                        plain(F.filter("spans", good)).alias("all_spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
