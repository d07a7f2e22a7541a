import json

import pytest

from mediameta.functions import filename as fn

# Published example names with their season, episode, checksum, confidence and title.
PUBLISHED = [
    ("Supêsuopera---aku-no-teiô-sama-to-sutârôdo-san-kimi-6-gô-to-no-saishû-kessen-02 (S01E02v2).mkv",
     1, 2, None, 0.9, "Supêsuopera - Aku no Teiô-sama to Sutârôdo-san Kimi 6-gô to no Saishû Kessen"),
    ("Usagi-san wa īsutā no yume o mite iru (1080p).ADN.WEB-DL.AAC2.0.H.264-ToBlave.[23A0FB72].mkv",
     None, None, "23A0FB72", 0.1, "Usagi-san wa īsutā no yume o mite iru"),
    ("[Huh?]Burankugēto.-.uchū.no.nazo.Season1_Eps22(720p).FLAC.H.265.[39AB5490].mkv",
     1, 22, "39AB5490", 1.0, "Burankugēto - uchū no nazo"),
    ("Arknights - Enshin Shomei - 24 [x].mkv", None, 24, None, 0.75, "Arknights - Enshin Shomei"),
    ("Silent Witch - Chinmoku no Majo no Kakushigoto - 07 [x].mkv", None, 7, None, 0.75,
     "Silent Witch - Chinmoku no Majo no Kakushigoto"),
]

OWN = [
    ("Kage no Machi - 27 (1080p).WEB-DL.[23a0fb72].mkv", None, 27, "23A0FB72", 0.75, "Kage no Machi"),
    ("Umi_no_oto-Midori_E03_(4k)[TAG].mkv", None, 3, None, 0.9, "Umi no oto-Midori"),
    ("[Grp] Nani ga inu-sama nda? - S03 - E07 - 3-Ri no hanashi 1080p AV1 [687A59F9].mkv", 3, 7, "687A59F9", 1.0, "Nani ga inu-sama nda?"),
    ("[Grp] Matte! 7-Jigen no neko-chan da! S02 -11- (AV1) (x265).mkv", 2, 11, None, 0.85, "Matte! 7-Jigen no neko-chan da!"),
    ("Show NCOP - 01.mkv", None, None, None, 0.1, "Show"),
    ("Show S01E05 OVA.mkv", 1, 5, None, 1.0, "Show"),
    ("Show 2nd Season - 03v2.mkv", 2, 3, None, 0.75, "Show"),
    ("9-nine-", None, None, None, 0.1, "9-nine-"),
    ("9-nine- - 03", None, 3, None, 0.75, "9-nine-"),
    ("Show - 1080p.mkv", None, None, None, 0.1, "Show"),
    ("Ranma 1-2", None, None, None, 0.1, "Ranma 1-2"),
    ("Ranma 1-2 (Alt Title) - 05 [1080p]", None, 5, None, 0.75, "Ranma 1-2 (Alt Title)"),
    ("Show-04-x", None, 4, None, 0.75, "Show"),
    ("Show_-_07_[x]", None, 7, None, 0.75, "Show"),
    ("Show (Alt Title 1080p) - 05.mkv", None, 5, None, 0.75, "Show (Alt Title 1080p)"),
    ("Show (1080p HEVC) - 05.mkv", None, 5, None, 0.75, "Show"),
    ("Show Season 2 Episode 12 [ABC].mkv", 2, 12, None, 1.0, "Show"),
    ("Show [ABCDEF123].mkv", None, None, None, 0.1, "Show"),
    ("Show - 3-Ri no baka - 07.mkv", None, 7, None, 0.75, "Show - 3-Ri no baka"),
    ("Title - 12-sai no haru - 03 [x].mkv", None, 3, None, 0.75, "Title - 12-sai no haru"),
    ("Show - 9-nine- - 04 [1080p].mkv", None, 4, None, 0.75, "Show - 9-nine-"),
    ("Show - 3-Ri no baka.mkv", None, None, None, 0.1, "Show - 3-Ri no baka"),
    ("Show - 05- (AV1).mkv", None, 5, None, 0.75, "Show"),
    ("opera house - 02.mkv", None, 2, None, 0.75, "opera house"),
    # A checksum that begins like an asset's token.
    ("Show - 05 [ED123456].mkv", None, 5, "ED123456", 0.75, "Show"),
    ("Show - 05 [CM] [ED478140].mkv", None, None, "ED478140", 0.1, "Show"),
    ("Show - 05 [ed478140] x.mkv", None, 5, None, 0.75, "Show"),
    ("Show ED12 - 05 [AB123456].mkv", None, None, "AB123456", 0.1, "Show ED12"),
]


@pytest.fixture(scope="module")
def extracted(spark):
    names = [n for n, *_ in PUBLISHED + OWN]
    df = spark.createDataFrame(list(enumerate(names)), "row_id bigint, name string")
    return fn.extract_metadata(df).orderBy("row_id").collect()


@pytest.mark.parametrize("i", range(len(PUBLISHED + OWN)))
def test_extraction(extracted, i):
    name, *want = (PUBLISHED + OWN)[i]
    r = extracted[i]
    assert [r.season, r.episode, r.crc_hash, r.confidence, r.show_name] == want, name


def test_target_is_one_line_in_order(extracted):
    for r in extracted:
        assert "\n" not in r.target
        obj = json.loads(r.target)
        assert list(obj) == ["show_name", "season", "episode", "crc_hash", "confidence", "reasoning"]
        assert obj["reasoning"] and obj["confidence"] == r.confidence
        assert r.episode is not None or r.confidence <= 0.2


def test_null_name(spark):
    r = fn.extract_metadata(spark.createDataFrame([(1, None)], "row_id bigint, name string")).first()
    assert r.show_name is None and r.episode is None
