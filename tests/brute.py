"""Brute-force per-topic measures on Python lists (test oracle).

ranking: list of (docno, sim); qrels: dict docno -> rel.  Ranking order is
score desc, docno desc (the evaluator's tie rule).
"""
import math


def judged_list(ranking, qrels):
    ordered = sorted(ranking, key=lambda x: (-x[1], tuple(-ord(c) for c in x[0])))
    out = []
    for d, _ in ordered:
        if d not in qrels:
            out.append(-1)
        elif qrels[d] < 0:
            out.append(-2)
        else:
            out.append(qrels[d])
    return out


def measures(ranking, qrels, level=1):
    rels = judged_list(ranking, qrels)
    R = sum(1 for v in qrels.values() if v >= level)
    NR = sum(1 for v in qrels.values() if 0 <= v < level)
    ret = len(rels)
    rr = sum(1 for v in rels if v >= level)
    out = {"num_ret": ret, "num_rel": R, "num_rel_ret": rr}
    k, s = 0, 0.0
    for i, v in enumerate(rels, 1):
        if v >= level:
            k += 1
            s += k / i
    out["map"] = s / R if R else 0.0
    out["recip_rank"] = next((1.0 / i for i, v in enumerate(rels, 1) if v >= level), 0.0)
    for n in (5, 10):
        out[f"P_{n}"] = sum(1 for v in rels[:n] if v >= level) / n
        out[f"recall_{n}"] = (sum(1 for v in rels[:n] if v >= level) / R) if R else 0.0
    out["Rprec"] = (sum(1 for v in rels[:R] if v >= level) / R) if R else 0.0
    # bpref
    nonrel, b = 0, 0.0
    for v in rels:
        if v < 0:
            continue
        if v < level:
            nonrel += 1
        else:
            b += (1.0 - min(nonrel, R) / min(NR, R)) if nonrel > 0 else 1.0
    out["bpref"] = b / R if R else 0.0
    # ndcg with gain = level
    dcg = sum((v / math.log2(i + 1)) for i, v in enumerate(rels, 1) if v > 0)
    ideal = sorted([v for v in qrels.values() if v > 0], reverse=True)
    idcg = sum(g / math.log2(i + 1) for i, g in enumerate(ideal, 1))
    out["ndcg"] = dcg / idcg if idcg > 0 else 0.0
    out["success_1"] = 1.0 if rels[:1] and rels[0] >= level else 0.0
    return out
