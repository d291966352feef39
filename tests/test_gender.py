from itertools import product

from telmart.functions.gender import normalise_gender, register


def common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(previous[j - 1] + 1 if x == y else max(previous[j], row[-1]))
    return row[-1]


def similar(word: str, target: str) -> bool:
    return 400 * common(word, target) >= 139 * (len(word) + len(target))


def expected(word: str | None) -> str | None:
    if word is None:
        return None
    word = word.lower()
    if word == "f" or "fe" in word:
        return "female"
    if word == "m" or "ma" in word:
        return "male"
    for target in ("male", "female"):
        if similar(word, target):
            return target
    return None


def classify(spark, words):
    frame = spark.createDataFrame([(word,) for word in words], "word string")
    return {tuple(row) for row in frame.select("word", normalise_gender("word")).collect()}


def test_all_short_words(spark):
    words = ["".join(letters) for size in range(6) for letters in product("malefx", repeat=size)]
    assert classify(spark, words) == {(word, expected(word)) for word in words}


def test_longer_and_odd_words(spark):
    words = [
        "m", "F", "MAL", "FEMAL", "female]", "Male ", "fmale", "emmle", "fxxmxxlxe", "efmal", "mxaxlxe",
        "mxxaxle", "axle", "male\n", "f\nm\nl\ne", "unknown", "", None, "x" * 200, "fm" + "x" * 9 + "ale",
    ]
    assert classify(spark, words) == {(word, expected(word)) for word in words}


def test_sql_function(spark):
    register(spark)
    found = spark.sql("SELECT normalise_gender(w) FROM VALUES ('mal'), ('Femal'), ('zz'), (null) AS t(w)")
    assert [row[0] for row in found.collect()] == ["male", "female", None, None]
