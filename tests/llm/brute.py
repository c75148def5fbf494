"""Plain Python forms of the operators, for tables that fit a test."""

import base64
import hashlib
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import tiktoken

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def shingles(words, size=5):
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def components(docs):
    """``{id: (set size, component)}`` over all pairs that share a shingle."""
    sets = {i: shingles(WORD.findall(lower(text))) for i, text in docs}
    holders = defaultdict(list)
    for i, own in sets.items():
        for shingle in own:
            holders[shingle].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(own), root(i)) for i, own in sets.items()}


def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encoded(docs):
    """``{id: (tokens, sha of ids, sha of decoded bytes)}``"""
    own = encoding()
    found = {}
    for i, text in docs:
        ids = own.encode_ordinary(text or "")
        found[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(own.decode_bytes(ids)))
    return found


def without_repeats(docs, size=20):
    """``{id: (words, removed, sha of the kept text)}``"""
    first = {}
    words = {i: WORD.findall(text or "") for i, text in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), (i, k))
    found = {}
    for i, own in words.items():
        gone = set()
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] != (i, k):
                gone.update(range(k, k + size))
        kept = [w for k, w in enumerate(own) if k not in gone]
        found[i] = (len(own), len(gone), sha(" ".join(kept)))
    return found


def phrases(text, sample):
    """Cross-parsing of bytes against bytes, by searching the sample."""
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def leaks(docs, items):
    """``(doc, item)`` of every verified item, from all stretches of twice its words."""
    from termlode.llm.decontaminate import question_and_answer

    found = set()
    for item, text in items:
        question, answer = (PLAIN_WORD.findall(lower(x)) for x in question_and_answer(text or ""))
        if not question:
            question, answer = answer, []
        if not question:
            continue
        asked, size = shingles(question), min(5, len(question))
        for doc, body in docs:
            words = PLAIN_WORD.findall(lower(body))
            span = len(question) + len(answer)
            for k in range(max(1, len(words) - span + 1)):
                part = words[k : k + span]
                seen = {tuple(part[j : j + size]) for j in range(len(part) - size + 1)}
                if 100 * len(asked & seen) >= 75 * len(asked) and (
                    100 * len(set(answer) & set(part)) >= 75 * len(set(answer))
                ):
                    found.add((doc, item))
                    break
    return found
