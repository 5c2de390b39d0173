"""Plain alignment of two tokenizers, whole texts, every pair of tokens."""

import hashlib
import os
from collections import Counter

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def tokenizers():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def tokens(a, b, text):
    """((id, bytes) of A, of B), or None where a side does not give the text back."""
    from churnframe.llm.bpe import byte_alphabet
    alphabet = byte_alphabet()
    if not text:
        return None
    whole = " " + text
    xs = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(whole, add_special_tokens=False).ids]
    ys = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
          for i in b.encode(text)]
    same = all(b"".join(t for _, t in z) == whole.encode() for z in (xs, ys))
    return (xs, ys) if same else None


def spans(ts):
    out, at = [], 0
    for i, t in ts:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def figures(texts):
    a, b = tokenizers()
    docs, count = {}, Counter()
    for key, text in texts.items():
        got = tokens(a, b, text)
        if got is None:
            docs[key] = None
            continue
        xs, ys = map(spans, got)
        links = [(x, y) for x, s, e in xs for y, s2, e2 in ys if s < e2 and s2 < e]
        common = sorted({e for _, _, e in xs} & {e for _, _, e in ys})
        start, groups = 0, []
        for c in common:
            groups.append(",".join(str(i) for i, s, e in xs if start <= s and e <= c) + "|"
                          + ",".join(str(i) for i, s, e in ys if start <= s and e <= c))
            start = c
        docs[key] = (len(xs), len(ys), groups, links)
        count.update(links)
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = {}
    for key, d in docs.items():
        if d is None:
            out[key] = (0, 0, 0, 0, "", 0, 0)
            continue
        n_a, n_b, groups, links = d
        out[key] = (n_a, n_b, len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(),
                    sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links))
    return out
