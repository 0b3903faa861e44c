"""A small sequential template miner, for comparison: lines arrive one by one, a leaf is
chosen by token count and leading tokens, and a line joins the most similar group."""

import re


def mine(contents, masks, depth=4, similarity=0.5):
    leaves, result = {}, []
    for content in contents:
        for pattern in masks:
            content = re.sub(pattern, "<*>", content)
        tokens = content.split()
        lead = tuple("<*>" if re.search(r"\d", t) else t for t in tokens[: depth - 2])
        groups = leaves.setdefault((len(tokens), lead), [])
        best, best_score = None, (-1, -1)
        for group in groups:
            same = sum(a == b and a != "<*>" for a, b in zip(group["tokens"], tokens))
            score = (same / len(tokens), group["tokens"].count("<*>"))
            if score > best_score:
                best, best_score = group, score
        if best is None or best_score[0] < similarity:
            best = {"tokens": list(tokens)}
            groups.append(best)
        best["tokens"] = [a if a == b else "<*>" for a, b in zip(best["tokens"], tokens)]
        result.append(best)
    return [" ".join(g["tokens"]) for g in result]
