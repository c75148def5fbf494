"""Fixed inputs and small helpers of the tests; fixtures are in ``conftest.py``."""

CORPUS = [
    ("c1/001.txt", "c1", "Red fox, red dog.\n\nFox-hunt & dog!\n"),
    ("c1/002.txt", "c1", "Blue dog\n"),
    ("c1/003.txt", "c1", "red_fox's DOG - cat \"cat\" 'x' ."),
    ("c1/004.txt", "c1", "Blue dog\n"),
    ("c2/001.txt", "c2", "Red £5 café"),
]
SF_DIR = "/root/testdata/sf0.001"


def make_docs(spark, rows):
    return spark.createDataFrame(rows, "file string, collection string, text string").select(
        "collection", "file", "text"
    )


def rows(frame, *columns):
    """Sorted tuples of a frame, doubles rounded to six places."""
    picked = frame.select(*columns) if columns else frame
    return sorted(
        (
            tuple(round(v, 6) if isinstance(v, float) else v for v in row)
            for row in picked.collect()
        ),
        key=repr,
    )


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()
