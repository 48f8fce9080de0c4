"""Small awkward documents that every operator is tried on."""

TEXTS = [
    None,
    "",
    " ",
    "one",
    "The cat sat. The cat sat.",
    "The cat sat. The cat sat.",
    "Write to ann.b@mail.example.com or +1 (555) 123-4567, host 10.0.0.255 and 10.0.0.256.",
    "card 4111 1111 1111 1111 and 4111111111111112, then +1 (578) 555-6437 4918187128635271",
    "a@b.c_d@e.f x@y.z.w 1.2.3.4.5 00.001.255.1 IBAN GB82 WEST 1234 5698 7654 32",
    "Été à l'île ß 中文 😀 \t\r\n mixed space \x1c odd",
    "long " * 3000,
    "x" * 9000,
    "don't we've 'll  they're   12345 !!??",
]


def frame(spark, extra: bool = True):
    rows = [(i if i != 3 else None, t, "en", 7) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int")
    return df.repartition(3) if extra else df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_tokens int")
