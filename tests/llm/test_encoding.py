import pytest

from loomspark.llm import encoding

SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize("piece,overlap", [(40, 8), (64, 30), (16384, 512)])
def test_pieces_give_the_ids_of_the_whole(spark, piece, overlap):
    texts = [
        "The quick brown fox isn't here. " * 9, "a" * 300, " " * 200, "x\n\n\n  y\t\t" * 40, "한국어 문장을 여러 번 되풀이한다. " * 12, "<|endoftext|> is text " * 8, "👩‍🔧🚀" * 50, "", None, "don't'll've" * 20,
        "word " * 30 + "b" * 100 + " word" * 30,
    ]
    d = spark.createDataFrame(list(enumerate(texts)), SCHEMA).selectExpr("*", "1 as ids", "2 as win")
    enc = encoding.byte_encoding()
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(d, piece_chars=piece, overlap=overlap).collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert enc.decode_bytes(got[4]) == texts[4].encode()


def test_empty(spark):
    assert encoding.encode_corpus(spark.createDataFrame([], SCHEMA)).count() == 0
