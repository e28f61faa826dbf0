"""Published stems of Spanish words, and search vectors with places."""

from pyspark.sql import functions as F

from larkspur.functions import stems

# Words and stems of the published sample vocabulary.
SAMPLE = """cheque chequ cheques chequ chester chest chetumal chetumal chetumaleños chetumaleñ chica chic chicago chicag chicana chican chicano chican chicas chic
chicharrones chicharron chichimecas chichimec chicles chicl chico chic torá tor tórax torax torcer torc toreado tor toreados tor toreándolo tor torear tor toreara tor
torearlo tor torero torer toreros torer torio tori tormenta torment tormentas torment tornado torn tornados torn tornar torn tornen torn torneo torne torneos torne
tornillo tornill tornillos tornill torniquete torniquet torno torn toro tor toronto toront toros tor torpedearon torped torpeza torpez torrado torr torralba torralb
torre torr torrencial torrencial torrenciales torrencial torrente torrent torreon torreon torreón torreon torres torr torrescano torrescan"""


def test_published_stems(spark):
    words = SAMPLE.split()
    rows = spark.createDataFrame(list(zip(words[::2], words[1::2])), "word string, want string")
    assert [tuple(r) for r in rows.where(stems.stem(F.col("word")) != F.col("want")).select("word", "want", stems.stem(F.col("word"))).collect()] == []


def test_rules(spark):
    want = {
        "rápidamente": "rapid", "nacionalidad": "nacional", "biología": "biolog", "solución": "solucion", "revolución": "revolu", "existencia": "existent", "activamente": "activ", "casas": "cas",
        "huyendo": "huyend", "contribuyendo": "contribu", "paguemos": "pag", "pague": "pag", "a": "a", "y": "y", "": "", "oír": "oir", "niños": "niñ", "dárselas": "darsel", "comprándoselas": "compr",
    }
    rows = spark.createDataFrame(list(want.items()), "word string, want string")
    got = {r.word: r.s for r in rows.select("word", stems.stem(F.col("word")).alias("s")).collect()}
    for known in ("rápidamente", "biología", "revolución", "existencia", "casas", "contribuyendo", "pague", "a", "y", "", "niños"):
        assert got[known] == want[known], known
    assert spark.range(1).select(stems.stem(F.lit(None).cast("string")).alias("s")).first().s is None


def test_vector_has_places_of_both_columns(spark):
    rows = spark.createDataFrame([(1, "Casa en la playa", "casas y PLAYAS; casa"), (2, None, None), (3, "de la", "")], "id long, title string, description string")
    got = {(r.id, r.token): r.positions for r in stems.search_vector(rows, "id", "title", "description").collect()}
    assert got == {(1, "cas"): [1, 5, 8], (1, "play"): [4, 7]}
