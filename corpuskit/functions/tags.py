"""Language tags: labels of identification models made well-formed BCP 47 tags."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "__label__"

#: ISO 639-1 codes, sorted, each with the ISO 639-3 code that it stands for.
_SHORTER = """
    ab=abk af=afr ak=aka am=amh as=asm ba=bak be=bel bg=bul bi=bis bm=bam bn=ben bo=bod bs=bos ca=cat ce=che cs=ces cv=chv cy=cym da=dan de=deu dz=dzo
    ee=ewe el=ell en=eng eo=epo es=spa et=est eu=eus fa=fas fi=fin fj=fij fo=fao fr=fra ga=gle gd=gla gl=glg gn=grn gu=guj ha=hau he=heb hi=hin hr=hrv
    ht=hat hu=hun hy=hye id=ind ig=ibo is=isl it=ita ja=jpn jv=jav ka=kat kg=kon ki=kik kk=kaz kl=kal km=khm kn=kan ko=kor ku=kur ky=kir lb=ltz lg=lug
    li=lim ln=lin lo=lao lt=lit lv=lav mg=mlg mi=mri mk=mkd ml=mal mn=mon mr=mar ms=msa mt=mlt my=mya nb=nob nl=nld nn=nno nv=nav ny=nya oc=oci om=orm
    os=oss pa=pan pl=pol ps=pus pt=por rm=roh rn=run ro=ron ru=rus rw=kin sa=san sc=srd sd=snd sg=sag si=sin sk=slk sl=slv sm=smo sn=sna so=som sq=sqi
    ss=ssw st=sot su=sun sv=swe ta=tam te=tel tg=tgk th=tha ti=tir tk=tuk tn=tsn to=ton tr=tur ts=tso tw=twi ty=tah ug=uig uk=ukr ur=urd uz=uzb vi=vie
    wo=wol xh=xho yi=yid yo=yor zu=zul
"""
REPLACED = {long: short for short, long in (x.split("=") for x in _SHORTER.split())}
REPLACED |= {"que": "qu", "als": "gsw", "eml": "x-eml", "prs": "fa-AF", "tgl": "fil"}
#: Codes that are only replaced together with one of these scripts.
REPLACED |= {f"{long}_{script}": f"{short}-{script}" for long, short, scripts in (("ara", "ar", "Latn Arab"), ("kas", "ks", "Deva Arab"), ("kau", "kr", "Latn Arab"), ("zho", "zh", "Hant Hans"), ("srp", "sr", "Cyrl"), ("tat", "tt", "Cyrl")) for script in scripts.split()}

#: RFC 5646: language with script, region, variants, extensions and private use; or private use alone; or a grandfathered tag.
WELL_FORMED = (
    r"(?i)^(?:(?:[a-z]{2,3}(?:-[a-z]{3}){0,3}|[a-z]{4}|[a-z]{5,8})(?:-[a-z]{4})?(?:-(?:[a-z]{2}|[0-9]{3}))?(?:-(?:[a-z0-9]{5,8}|[0-9][a-z0-9]{3}))*(?:-[a-wy-z0-9](?:-[a-z0-9]{2,8})+)*(?:-x(?:-[a-z0-9]{1,8})+)?"
    r"|x(?:-[a-z0-9]{1,8})+|i-(?:ami|bnn|default|enochian|hak|klingon|lux|mingo|navajo|pwn|tao|tay|tsu)|en-gb-oed|sgn-(?:be-fr|be-nl|ch-de)|art-lojban|cel-gaulish|no-bok|no-nyn|zh-(?:guoyu|hakka|min|min-nan|xiang))$"
)


def fixed(label: Column) -> Column:
    """The label without the model's prefix, its code replaced where another stands for it, and ``-`` for ``_``. A label that is no longer than the prefix stays whole."""
    bare = F.when(F.length(label) >= len(PREFIX), F.substring(label, len(PREFIX) + 1, 1 << 20)).otherwise(label)
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(REPLACED.items()))])
    return F.replace(F.coalesce(F.element_at(table, bare), bare), F.lit("_"), F.lit("-"))


def well_formed(tag: Column) -> Column:
    return F.coalesce(tag.rlike(WELL_FORMED), F.lit(False))


def parsed(label: Column) -> Column:
    """``fixed``, or null where that is no well-formed tag."""
    tag = fixed(label)
    return F.when(well_formed(tag), tag)


def normalised(label: Column) -> Column:
    """The other way from a label to a tag: prefix off, ``-`` for ``_``, no replacement, and the usual case of each part (script Title, region UPPER); null where ill-formed."""
    tag = F.lower(F.replace(F.substring(label, len(PREFIX) + 1, 1 << 20), F.lit("_"), F.lit("-")))
    private = F.lit(False)
    parts = F.split(tag, "-")

    def case(x: Column, i: Column) -> Column:
        inner = F.array_contains(F.transform(F.slice(parts, 1, i), lambda p: F.length(p) == 1), True)
        return F.when((i == 0) | inner | private, x).when(F.length(x) == 2, F.upper(x)).when((F.length(x) == 4) & x.rlike("^[a-z]"), F.initcap(x)).otherwise(x)

    return F.when(well_formed(tag), F.array_join(F.transform(parts, case), "-"))
