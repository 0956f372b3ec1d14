"""Documents that every operator has to survive."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fp string, print string, found string, near string, line string, value string, kind string, gone string")


def odd_documents(spark, more=()):
    """Null, empty, blank and long texts, ties, repeated rows, null ids, clashing extra columns."""
    texts = ["", None, " \n\t ", "one", "Two words\nTwo words\n", "É été ÉTÉ\x0bx\x0cy", "a\n" * 300,
             "word " * 20_000, "x" * 50_000, "mixed 漢字 😀 ümlaut ß\r\nline"]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, None if i == 3 else len(t or ""))
            for i, t in enumerate([*texts, *more])]
    rows += [rows[4], rows[4], (None, None, None, None, None), (None, "no id here", "en", "src1", 10), (7, "other text", "en", "s", 1)]
    return spark.createDataFrame([r + ("clash",) * 8 for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)
