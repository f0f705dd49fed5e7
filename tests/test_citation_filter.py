from statloom.operators import citations as C

BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_no_block_is_dropped_before_it_is_searched(spark):
    far = [f"{k}{b}431:10-2" for k in ("section", "Chapters", "§§", "ſection") for b in ("\n" + " " * 40, " [\u2009 ", "\n\t\xa0[" + " " * 20 + "\n", "")]
    texts = far + [f"section{b * 3}1-2" for b in BLANKS] + ["section x 1-2", "sections" + " " * 100_000, "no 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {(r.i, r.number) for r in C.detect(df, ["i"], "text").collect()}
    assert got == {(i, c[2]) for i, t in enumerate(texts) for c in C.candidates(t)}
    assert {i for i, _ in got} >= set(range(len(far)))
