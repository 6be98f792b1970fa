"""Logical tables of the named queries, derived from the star-schema parquet tables.

The queries speak of an order-entry schema, taxi trips, race results, passengers,
flights, car rentals and staff records. ``Warehouse`` maps those onto the tables in
one folder, whole, without sampling. Some keys are shifted by a few so that every
join meets unmatched rows on both sides, and some attributes are null where another
attribute has a given value, since the source tables hold no nulls.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared so that no job is spent on reading a footer for its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


class Warehouse:
    """Lazily defined logical tables over the parquet files of one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    # ---- order entry -----------------------------------------------------------

    @cached_property
    def products(self) -> DataFrame:
        c = F.col
        return self.raw("part").select(
            c("p_partkey").alias("product_id"),
            c("p_name").alias("product_name"),
            (F.substring_index("p_brand", "#", -1).cast("int") - 1).alias("category_id"),
            text(c("p_size"), " x ", F.lower("p_type")).alias("quantity_per_unit"),
            F.when(c("p_size") < 50, c("p_retailprice").cast("decimal(12,2)")).alias("unit_price"),
            c("p_size").alias("units_in_stock"),
            F.when(c("p_type") == "PROMO", 1).otherwise(0).alias("discontinued"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("category_id"),
            F.replace(F.col("n_name"), F.lit("NATION"), F.lit("Category")).alias("category_name"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = F.col
        nation = self.raw("nation").join(
            self.raw("region"), c("n_regionkey") == c("r_regionkey"), "inner"
        )
        return (
            self.raw("customer")
            .join(nation, c("c_nationkey") == c("n_nationkey"), "inner")
            .select(
                c("c_custkey").alias("customer_id"),
                c("c_name").alias("company_name"),
                text("Contact ", c("c_custkey")).alias("contact_name"),
                c("c_mktsegment").alias("contact_title"),
                text("Street ", c("c_custkey")).alias("address"),
                text(c("n_name"), " city").alias("city"),
                F.nullif(c("r_name"), F.lit("ASIA")).alias("region"),
                F.lpad(c("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
                c("n_name").alias("country"),
                text(c("c_nationkey") + 10, "-", c("c_custkey")).alias("phone"),
                F.lit(None).cast("string").alias("fax"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        c = F.col
        day = c("o_orderdate").cast("date")
        return self.raw("orders").select(
            c("o_orderkey").alias("order_id"),
            (c("o_custkey") + 10).alias("customer_id"),
            F.expr("o_custkey div 15").alias("employee_id"),
            day.alias("order_date"),
            F.date_add(day, 28).alias("required_date"),
            F.when(c("o_orderstatus") != "P", F.date_add(day, 7)).alias("shipped_date"),
            F.left(c("o_orderpriority"), F.lit(1)).cast("int").alias("ship_via"),
            c("o_totalprice").cast("decimal(18,2)").alias("freight"),
            text("NATION_", c("o_custkey") % 25).alias("ship_country"),
        )

    @cached_property
    def order_details(self) -> DataFrame:
        c = F.col
        return self.raw("lineitem").select(
            c("l_orderkey").alias("order_id"),
            c("l_partkey").alias("product_id"),
            c("l_linenumber").alias("line_no"),
            c("l_suppkey").alias("supplier_id"),
            c("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
            c("l_quantity").cast("int").alias("quantity"),
            c("l_discount").alias("discount"),
        )

    @cached_property
    def employees(self) -> DataFrame:
        c = F.col
        balance = F.floor("s_acctbal").cast("int")
        return self.raw("supplier").select(
            c("s_suppkey").alias("employee_id"),
            text("Name", c("s_nationkey")).alias("first_name"),
            c("s_name").alias("last_name"),
            F.when(c("s_acctbal") > 6000, "Sales Manager")
            .when(c("s_acctbal") > 0, "Sales Representative")
            .alias("title"),
            F.date_add(F.lit("1970-01-01").cast("date"), balance).alias("birth_date"),
            F.date_add(F.lit("1992-01-01").cast("date"), c("s_nationkey") * 30).alias("hire_date"),
            F.expr("CASE WHEN s_suppkey > 0 THEN s_suppkey div 10 END").alias("reports_to"),
        )

    @cached_property
    def employee_territories(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("employee_id"), F.col("s_nationkey").alias("territory_id")
        )

    @cached_property
    def territories(self) -> DataFrame:
        return self.raw("nation").select(
            (F.col("n_nationkey") + 3).alias("territory_id"),
            F.col("n_name").alias("territory_description"),
        )

    @cached_property
    def regions(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_description")
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        c = F.col
        shared = F.replace(c("s_name"), F.lit("Supplier"), F.lit("Customer"))
        return self.raw("supplier").select(
            c("s_suppkey").alias("supplier_id"),
            F.when(c("s_acctbal") < 5000, shared).otherwise(c("s_name")).alias("company_name"),
        )

    @cached_property
    def shippers(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").alias("shipper_id"), F.col("r_name").alias("company_name")
        )

    # ---- trips, results, logs, passengers ---------------------------------------

    @cached_property
    def trips(self) -> DataFrame:
        c = F.col
        rate = F.when(c("l_returnflag") == "A", "Group Ride").when(
            c("l_returnflag") == "R", "Negotiated"
        )
        return self.raw("lineitem").select(
            text(c("l_orderkey"), "-", c("l_linenumber"), "-", c("l_partkey"), "-", c("l_suppkey"))
            .alias("trip_id"),
            (c("l_suppkey") % 2 + 1).alias("VendorID"),
            c("l_shipdate").alias("tpep_pickup_datetime"),
            c("l_linenumber").alias("passenger_count"),
            c("l_quantity").alias("trip_distance"),
            rate.otherwise("Standard").alias("RatecodeID"),
            F.when(c("l_linestatus") == "O", 1).otherwise(2).alias("payment_type"),
            (c("l_discount").cast("decimal(4,2)") * c("l_quantity").cast("int")).alias(
                "tip_amount"
            ),
            c("l_tax").alias("tolls_amount"),
            c("l_discount").alias("congestion_surcharge"),
            F.nullif(c("l_tax"), F.lit(0.0)).alias("airport_fee"),
            c("l_extendedprice").alias("total_amount"),
        )

    @cached_property
    def results(self) -> DataFrame:
        c = F.col
        return self.raw("lineitem").select(
            c("l_orderkey").alias("raceId"),
            c("l_partkey").alias("driverId"),
            c("l_suppkey").alias("constructorId"),
            c("l_quantity").alias("points"),
        )

    @cached_property
    def drivers(self) -> DataFrame:
        c = F.col
        return self.raw("part").select(
            c("p_partkey").alias("driverId"),
            c("p_name").alias("forename"),
            c("p_brand").alias("surname"),
            c("p_type").alias("nationality"),
        )

    @cached_property
    def constructors(self) -> DataFrame:
        c = F.col
        return self.raw("supplier").select(
            c("s_suppkey").alias("constructorId"),
            F.lower("s_name").alias("constructorRef"),
            c("s_name").alias("name"),
            text("Nationality ", c("s_nationkey")).alias("nationality"),
            text("https://example.org/", c("s_suppkey")).alias("url"),
        )

    @cached_property
    def races(self) -> DataFrame:
        c = F.col
        return self.raw("orders").select(
            c("o_orderkey").alias("raceId"),
            F.year(c("o_orderdate").cast("date")).alias("year"),
            c("o_orderpriority").alias("name"),
            text("https://example.org/race/", c("o_orderkey")).alias("url"),
        )

    @cached_property
    def logs_may(self) -> DataFrame:
        c = F.col
        return self.raw("customer").select(
            c("c_custkey").alias("id"),
            c("c_name").alias("first_name"),
            c("c_mktsegment").alias("last_name"),
            F.when(c("c_acctbal") > -900, _ip(c("c_custkey"))).alias("ip_address"),
        )

    @cached_property
    def logs_april(self) -> DataFrame:
        c = F.col
        return self.raw("supplier").select(
            c("s_suppkey").alias("id"),
            c("s_name").alias("first_name"),
            text("Nation ", c("s_nationkey")).alias("last_name"),
            F.when(c("s_acctbal") > -900, _ip(c("s_suppkey") * 20)).alias("ip_address"),
        )

    @cached_property
    def passengers(self) -> DataFrame:
        c = F.col
        segment = c("c_mktsegment")
        return self.raw("customer").select(
            c("c_custkey").cast("string").alias("PassengerId"),
            F.when(c("c_acctbal") > 4500, "1").otherwise("0").alias("Survived"),
            (c("c_nationkey") % 3 + 1).cast("string").alias("Pclass"),
            c("c_name").alias("Name"),
            F.when(segment.isin("MACHINERY", "AUTOMOBILE"), "male")
            .when(segment.isin("FURNITURE", "HOUSEHOLD"), "female")
            .alias("Sex"),
            F.when(c("c_acctbal") >= 0, text(F.floor("c_acctbal") % 80, ".5")).alias("Age"),
            F.lit("0").alias("SibSp"),
            F.lit("0").alias("Parch"),
            text("T", c("c_custkey")).alias("Ticket"),
            c("c_acctbal").alias("Fare"),
            F.when(segment != "BUILDING", text("C", c("c_nationkey"))).alias("Cabin"),
            F.left(segment, F.lit(1)).alias("Embarked"),
        )

    # ---- flights, rentals, staff ---------------------------------------------------

    def flights_raw(self, domestic: str, before: bool) -> DataFrame:
        """One yearly file as delivered: text columns, long headers, own label spelling."""
        c = F.col
        day = c("l_shipdate").cast("date")
        split = F.lit("1998-07-01").cast("timestamp_ntz")
        rows = self.raw("lineitem").where(
            c("l_shipdate") < split if before else c("l_shipdate") >= split
        )
        line = c("l_linenumber")
        airline = F.when(line == 6, "0").when(line < 6, text("Airline ", c("l_suppkey") % 50))
        return rows.select(
            F.date_format(day, "dd/MM/yyyy").alias("Fecha"),
            text(line + 10, ":", c("l_quantity").cast("int") + 9).alias("Hora UTC"),
            F.when(c("l_tax") > 0, "Regular").otherwise("No Regular").alias(
                "Clase de Vuelo (todos los vuelos)"
            ),
            F.when(c("l_linestatus") == "O", domestic)
            .otherwise("Internacional")
            .alias("Clasificación Vuelo"),
            F.when(c("l_returnflag") == "R", "Aterrizaje")
            .otherwise("Despegue")
            .alias("Tipo de Movimiento"),
            text("AP", c("l_suppkey") % 30).alias("Aeropuerto"),
            text("AP", c("l_partkey") % 25).alias("Origen / Destino"),
            airline.alias("Aerolinea Nombre"),
            F.when(c("l_discount") > 0, text("BO-", c("l_partkey") % 97))
            .otherwise("0")
            .alias("Aeronave"),
            F.when(c("l_quantity") < 50, c("l_quantity").cast("int").cast("string")).alias(
                "Pasajeros"
            ),
            F.lit("DEFINITIVO").alias("Calidad dato"),
        )

    @cached_property
    def airports_raw(self) -> DataFrame:
        c = F.col
        nation = self.raw("nation").join(
            self.raw("region"), c("n_regionkey") == c("r_regionkey"), "inner"
        )
        key = c("n_nationkey")
        return nation.select(
            text("AP", key).alias("local"),
            text("SA", key).alias("oaci"),
            text("I", key).alias("iata"),
            F.lit("Aeródromo").alias("tipo"),
            c("n_name").alias("denominacion"),
            text(key, "S ", key, "W").alias("coordenadas"),
            text("-", key).alias("latitud"),
            text("-", key + 40).alias("longitud"),
            text(key * 12, ".5").alias("elev"),
            F.lit("Metros").alias("uom_elev"),
            c("n_name").alias("ref"),
            F.when(key % 4 > 0, text(key, ".25")).alias("distancia_ref"),
            F.lit("NE").alias("direccion_ref"),
            F.lit("PUBLICO").alias("condicion"),
            F.lit("CONTROL").alias("control"),
            text("R", c("n_regionkey")).alias("region"),
            F.lit("SAEF").alias("fir"),
            F.lit("CIVIL").alias("uso"),
            F.lit("Nacional").alias("trafico"),
            F.lit("SI").alias("sna"),
            F.lit("NO").alias("concesionado"),
            c("r_name").alias("provincia"),
            F.lit("NO").alias("inhab"),
        )

    @cached_property
    def rentals_raw(self) -> DataFrame:
        c = F.col
        size = c("p_size")
        fuel = (
            F.when(c("p_type") == "ECONOMY", "ELECTRIC")
            .when(c("p_type") == "STANDARD", "HYBRID")
            .when(c("p_type") == "PROMO", "DIESEL")
            .when(c("p_type") != "LARGE", "GASOLINE")
        )
        return self.raw("part").select(
            fuel.alias("fuelType"),
            F.when(size < 50, text(F.expr("p_size div 10"), ".", size % 10)).alias("rating"),
            size.cast("string").alias("renterTripsTaken"),
            (c("p_partkey") % 300).cast("string").alias("reviewCount"),
            c("p_name").alias("location.city"),
            F.lit("US").alias("location.country"),
            F.lit("1.0").alias("location.latitude"),
            F.lit("2.0").alias("location.longitude"),
            text("S", c("p_partkey") % 30).alias("location.state"),
            text("O", c("p_partkey") % 500).alias("owner.id"),
            c("p_retailprice").cast("int").cast("string").alias("rate.daily"),
            c("p_brand").alias("vehicle.make"),
            c("p_type").alias("vehicle.model"),
            F.lit("car").alias("vehicle.type"),
            (size + 1980).cast("string").alias("vehicle.year"),
        )

    @cached_property
    def states_raw(self) -> DataFrame:
        c = F.col
        key = c("n_nationkey")
        return self.raw("nation").select(
            F.lit("0,0").alias("Geo Point"),
            F.lit("{}").alias("Geo Shape"),
            F.lit("2021").alias("Year"),
            key.cast("string").alias("Official Code State"),
            c("n_name").alias("Official Name State"),
            F.lit("USA").alias("Iso 3166-3 Area Code"),
            F.lit("state").alias("Type"),
            text("S", key).alias("United States Postal Service state abbreviation"),
            key.cast("string").alias("State FIPS Code"),
            key.cast("string").alias("State GNIS Code"),
        )

    @cached_property
    def staff(self) -> DataFrame:
        c = F.col
        start = c("o_orderdate").cast("date")
        end = F.date_add(start, (c("o_custkey") % 1500).cast("int"))
        return self.raw("orders").select(
            c("o_orderkey").alias("Id"),
            text("Name ", c("o_orderkey")).alias("Nombre"),
            text("Surname ", c("o_custkey")).alias("Apellido"),
            c("o_orderpriority").alias("Area"),
            F.date_format(start, "MM/dd/yyyy").alias("Fecha comienzo"),
            F.date_format(end, "MM/dd/yyyy").alias("Fecha fin"),
            text("N", F.expr("o_custkey div 200")).alias("Nivel"),
            text("Grupo ", c("o_orderstatus")).alias("Grupo recruitment"),
            (c("o_custkey") % 6).cast("int").alias("Tiempo recruitment"),
            text("Rango ", c("o_custkey") % 27 + 1).alias("Rango Salarial"),
            text("Rango ", c("o_orderkey") % 25 + 1).alias("RS competencia"),
            F.expr("o_custkey div 15 + 2").alias("Manager"),
            F.when(c("o_orderstatus") == "F", "SI").otherwise("NO").alias("Realizo Cursos"),
        )

    @cached_property
    def salary_ranges(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.raw("nation").select(
            text("Rango ", key + 1).alias("Rango"),
            (key * 50000 + 150001).alias("desde"),
            (key * 50000 + 200000).alias("hasta"),
        )

    @cached_property
    def managers(self) -> DataFrame:
        c = F.col
        return self.raw("supplier").select(
            c("s_suppkey").alias("Id"),
            text("Name", c("s_nationkey")).alias("Nombre"),
            c("s_name").alias("Apellido"),
        )

    # ---- event streams ---------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")


def _ip(key: Column) -> Column:
    number = key.cast("bigint")
    return F.concat_ws(
        ".",
        F.lit("10"),
        (F.floor(number / 65536) % 256).cast("string"),
        (F.floor(number / 256) % 256).cast("string"),
        (number % 256).cast("string"),
    )
