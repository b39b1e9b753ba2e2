import random
import zlib

from armlens.llm import toxicity


def corpus(n=600):
    rnd = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rnd.choices(words, k=8)) + "." for _ in range(rnd.randint(1, 30))]
        bad = rnd.random() < 0.25
        if bad:
            for _ in range(2):
                sentences.insert(rnd.randint(0, len(sentences)), "you vile" + rnd.choice(["x", "yz", "q"]) + " thing here.")
        rows.append((i, " ".join(sentences)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark, make_docs):
    rows, labels = corpus()
    docs = make_docs(rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["id"]: r for r in toxicity.score_documents(docs, model).select(
        "row.doc_id", "score", "predicted", "offending").withColumnRenamed("doc_id", "id").collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == y for i, y in held) / len(held) > 0.97
    text = dict(rows)
    for i, y in held:
        assert 0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.5)
        if y and got[i]["predicted"]:
            words = text[i].split()
            for s in got[i]["offending"]:
                assert any(w.startswith("vile") for w in words[s["first_word"]:s["first_word"] + s["n_words"]])


def test_labels_of_the_held_out_fold_do_not_matter(spark, make_docs):
    rows, labels = corpus(200)
    flip = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    schema = "doc_id long, quality int, toxic int"
    a = toxicity.train(make_docs(rows), spark.createDataFrame(labels, schema))
    b = toxicity.train(make_docs(rows), spark.createDataFrame(flip, schema))
    assert a.bias == b.bias and (a.values == b.values).all()


def test_edges(spark, make_docs, edge_rows):
    none = toxicity.train(make_docs(edge_rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert none.bias is None
    got = toxicity.score_documents(make_docs(edge_rows), none).collect()
    assert len(got) == len(edge_rows) and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    rows, labels = corpus(200)
    odd = labels + [(None, 1, 1), (5, 1, None), (5, 1, 0)]
    model = toxicity.train(make_docs(rows), spark.createDataFrame(odd, "doc_id long, quality int, toxic int"))
    docs = make_docs(edge_rows)
    scored = toxicity.score_documents(docs, model)
    assert scored.select("row.*").columns == docs.columns
    by_text = {}
    for r in scored.collect():
        assert 0 <= r["score"] <= 1
        by_text.setdefault(r["row"]["text"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values()) and by_text[None] == by_text[""]
    assert toxicity.score_documents(make_docs([]), model).count() == 0
