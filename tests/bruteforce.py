"""Pure-Python versions of the reference's per-row history loops, used as a
second oracle on small random logs (rows in (timestamp, row_id) order)."""

from __future__ import annotations

import random
from collections import defaultdict


def random_log(seed: int, users: int = 12, max_rows: int = 30, n_content: int = 14):
    """Rows: dicts of the interactions schema. Ties in timestamp, users with
    one row, lecture-only users, content missing from the question table."""
    rnd = random.Random(seed)
    rows, rid = [], 0
    for u in range(users):
        n = 1 if u == 0 else rnd.randint(1, max_rows)
        lectures_only = u == 1
        ts = 0
        for _ in range(n):
            ts += rnd.choice([0, 0, 1, 3, 7, 20])
            is_lec = 1 if lectures_only else int(rnd.random() < 0.25)
            rows.append(dict(row_id=rid, timestamp=ts, user_id=u, content_id=rnd.randrange(n_content),
                             content_type_id=is_lec, task_container_id=ts // 10,
                             user_answer=-1 if is_lec else rnd.randrange(4),
                             answered_correctly=-1 if is_lec else rnd.randint(0, 1),
                             prior_question_elapsed_time=None if rnd.random() < 0.1 else float(rnd.randint(1, 50)),
                             prior_question_had_explanation=None if rnd.random() < 0.1 else rnd.random() < 0.5))
            rid += 1
    rnd.shuffle(rows)  # file order must not matter
    return rows


def random_dims(seed: int, n_questions: int = 10, n_lectures: int = 12):
    rnd = random.Random(seed + 1000)
    qs = []
    for q in range(n_questions):
        r = rnd.random()
        tags = None if r < 0.15 else ("7" if r < 0.25 else " ".join(str(rnd.randint(1, 9) * 11)
                                                                    for _ in range(rnd.randint(1, 3))))
        qs.append(dict(question_id=q, bundle_id=q // 3, correct_answer=q % 4,
                       part=None if q == 3 else rnd.randint(1, 7), tags=tags))
    ls = [dict(lecture_id=i, tag=rnd.randint(1, 9) * 11, part=rnd.randint(1, 7),
               type_of=rnd.choice(["concept", "intention", "solving question", "starter"]))
          for i in range(n_lectures)]
    return qs, ls


def ordered(rows):
    return sorted(rows, key=lambda r: (r["timestamp"], r["row_id"]))


def user_feats(question_rows):
    """add_user_feats: prior sum/count by user and (user, part), first_time."""
    s, c = defaultdict(int), defaultdict(int)
    ps, pc = defaultdict(int), defaultdict(int)
    seen = defaultdict(set)
    out = {}
    for r in ordered(question_rows):
        u, p = r["user_id"], (-1 if r["part"] is None else r["part"])
        out[r["row_id"]] = dict(
            answered_correctly_sum_u=s[u], count_u=c[u],
            answered_correctly_avg_u=(s[u] / c[u]) if c[u] else None,
            part_sum_u=ps[u, p], part_count_u=pc[u, p],
            part_avg_u=(ps[u, p] / pc[u, p]) if pc[u, p] else None,
            first_time=int(r["content_id"] not in seen[u]))
        s[u] += r["answered_correctly"]
        c[u] += 1
        ps[u, p] += r["answered_correctly"]
        pc[u, p] += 1
        seen[u].add(r["content_id"])
    return out


def lecture_loop(rows, questions, lectures):
    """The lecture-history loop, returned for question rows."""
    qd = {q["question_id"]: q for q in questions}
    ld = {l["lecture_id"]: l for l in lectures}
    state = {}
    out = {}
    for r in ordered(rows):
        u = r["user_id"]
        st = state.setdefault(u, dict(lectures=[], nq=0, parts=[0] * 7))
        if r["content_type_id"] == 1:
            st["lectures"].append(r["content_id"])
            continue
        st["nq"] += 1
        q = qd.get(r["content_id"])
        part = q["part"] if q else None
        if part is not None:
            st["parts"][part - 1] += 1
        seen = [ld[i] for i in st["lectures"] if i in ld]
        tags = set(int(t) for t in q["tags"].split()) if q and q["tags"] else set()
        out[r["row_id"]] = dict(
            num_lecture_seen=len(st["lectures"]), num_question_seen=st["nq"],
            num_tags_match=sum(1 for l in seen if l["tag"] in tags),
            part_matches=int(part is not None and any(l["part"] == part for l in seen)),
            **{f"part{i + 1}_seen": st["parts"][i] for i in range(7)})
    return out


def latest_lectures(rows, questions, lectures):
    """Per row the user's latest earlier lecture, and for questions the latest of a matching tag and of the part."""
    qd = {q["question_id"]: q for q in questions}
    ld = {l["lecture_id"]: l for l in lectures}
    seen, out = defaultdict(list), {}
    for r in ordered(rows):
        earlier, q = seen[r["user_id"]], None if r["content_type_id"] else qd.get(r["content_id"])
        tags = set(map(int, q["tags"].split())) if q and q["tags"] else set()
        part = q["part"] if q else None

        def last(fits):
            hit = [(x["content_id"], x["timestamp"]) for x in earlier if fits(ld.get(x["content_id"]))]
            return hit[-1] if hit else (None, None)

        out[r["row_id"]] = (*last(lambda l: True), *last(lambda l: l is not None and l["tag"] in tags),
                            *last(lambda l: l is not None and part is not None and l["part"] == part))
        if r["content_type_id"]:
            earlier.append(r)
    return out
