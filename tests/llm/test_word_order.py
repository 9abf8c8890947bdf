"""What the context model gathers grows with the corpus: the order of words that are far from the commonest."""

import random
import zlib

from highwater.llm.lm_score import score_documents


def test_pairs_of_rare_words_tell_their_order(spark):
    draw = random.Random(3)
    pairs = [(f"left{i}", f"right{i}") for i in range(3000)]

    def text(ordered):
        picked = draw.sample(pairs, 100)
        flat = [w for p in picked for w in p]
        if not ordered:
            draw.shuffle(flat)
        return " ".join(flat)

    held = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, text(i not in held or k % 2 == 0)) for k, i in enumerate(range(1000))]
    got = {r.doc_id: r for r in score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    order = {i: k % 2 == 0 for k, i in enumerate(range(1000)) if i in held}
    mean = {o: sum(got[i].score / got[i].n_tokens for i in order if order[i] == o) / sum(x == o for x in order.values()) for o in (True, False)}
    # Half of the tokens of an ordered text follow from the one before: about 3.5 decimal digits each.
    assert mean[True] > mean[False] + 1
    trained = [r.score / r.n_tokens for r in got.values() if not r.held_out]
    assert abs(sum(trained) / len(trained) - mean[True]) < 0.2  # a text does not predict itself
