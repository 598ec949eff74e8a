"""A small nested archive with every kind of valid, rejected and broken content."""

import io
import zipfile

from gondola.schemas import COMERCIO_HEADER, PRODUCTOS_HEADER, SUCURSALES_HEADER

FOOTER = "Última actualización: 2026-05-23T04:00:00-0300"


def row(header, **values):
    return "|".join(str(values.get(name, "")) for name in header)


def chain(**values):
    return row(COMERCIO_HEADER, **{"id_comercio": "1", "id_bandera": "1", **values})


def branch(number="1", **values):
    return row(SUCURSALES_HEADER, **{"id_comercio": "1", "id_bandera": "1", "id_sucursal": number, **values})


def price(product="7790", amount="100.5", number="1", **values):
    values = {"productos_precio_lista": amount, **values}
    return row(
        PRODUCTOS_HEADER,
        **{"id_comercio": "1", "id_bandera": "1", "id_sucursal": number, "id_producto": product, **values},
    )


def lines(header, *rows, bom=False):
    text = "\r\n".join(["|".join(header), *rows]) + "\r\n"
    return text.encode("utf-8-sig" if bom else "utf-8")


def member(chains=None, branches=None, prices=None, folder="", upper=False):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as inner:
        for name, content in (("comercio.csv", chains), ("sucursales.csv", branches), ("productos.csv", prices)):
            if content is not None:
                inner.writestr(folder + (name.upper() if upper else name), content)
    return packed.getvalue()


def simple_member(*prices, branches=1):
    return member(
        lines(COMERCIO_HEADER, chain(comercio_bandera_nombre="Uno")),
        lines(SUCURSALES_HEADER, *[branch("1", sucursales_localidad=f"Loc {i}") for i in range(branches)]),
        lines(PRODUCTOS_HEADER, *prices),
    )


def write_archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as outer:
        outer.writestr("leeme.txt", b"no es un zip interno")
        for name, content in members.items():
            outer.writestr(name, content)
    return str(path)


def full_archive(path):
    good_chain = lines(
        COMERCIO_HEADER,
        chain(comercio_bandera_nombre=" Uno ", comercio_ultima_actualizacion="2026-05-23T04:00:00-0300"),
        FOOTER,
    )
    good_branch = lines(SUCURSALES_HEADER, branch(sucursales_latitud="-34,6", sucursales_longitud="-58.4"))
    awkward = lines(
        PRODUCTOS_HEADER,
        price("a"),
        price("b") + "|de mas",
        "1|2|3",
        "",
        "|" * (len(PRODUCTOS_HEADER) - 1),
        row(PRODUCTOS_HEADER, id_comercio="x1", id_producto="c"),
        price("d", "", productos_marca='""', productos_leyenda_promo1="nan", productos_leyenda_promo2="None"),
    )
    numbers = ["1234.56", "1.234,56", "1,234.56", "1.234", "1d", "abc", ""]
    renamed = ["otra" if c == "productos_ean" else c for c in PRODUCTOS_HEADER]
    return write_archive(
        path,
        {
            "2026-05-23/cadena_1.zip": member(good_chain, good_branch, lines(PRODUCTOS_HEADER, price())),
            "2026-05-23/cadena_2.ZIP": member(
                lines(COMERCIO_HEADER, chain(id_bandera="2"), bom=True),
                lines(SUCURSALES_HEADER, branch(id_bandera="2"), bom=True),
                lines(
                    PRODUCTOS_HEADER,
                    price("q", id_bandera="2", productos_descripcion='"a|b"'),
                    price("r", id_bandera="2", productos_descripcion='"dos\nlineas"'),
                    bom=True,
                ),
                folder="carpeta/",
                upper=True,
            ),
            "2026-05-23/cadena_3.zip": member(good_chain, good_branch, awkward),
            "2026-05-23/cadena_4.zip": member(
                good_chain, good_branch, lines(PRODUCTOS_HEADER, *[price(f"n{i}", n) for i, n in enumerate(numbers)])
            ),
            "2026-05-23/cadena_5.zip": member(good_chain, good_branch, lines(renamed, price("mal"))),
            "2026-05-23/cadena_6.zip": member(good_chain, None, lines(PRODUCTOS_HEADER, price("sin sucursal"))),
            "2026-05-23/cadena_7.zip": b"",
            "2026-05-23/cadena_8.zip": b"esto no es un zip",
            "cadena_9.zip": member(good_chain, good_branch, lines(PRODUCTOS_HEADER, price("sin fecha"))),
            "2026-05-23/cadena_10.zip": member(good_chain, good_branch, lines(PRODUCTOS_HEADER, price("otra"))),
            "2026-05-23/cadena_11.zip": member(
                good_chain, good_branch, lines(PRODUCTOS_HEADER, price("bien")) + b"\xff\xfe|roto\r\n"
            ),
        },
    )
