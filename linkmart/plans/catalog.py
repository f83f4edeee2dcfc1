"""Entity and fact specs.

``WAREHOUSE`` restates the modelled warehouse's eight entities and nine facts (fixed
values: field names, staged/dim column names, which facts join current versions only).
``TESTBED`` maps the driver's generated tables onto the same shapes (see
``linkmart.sources.testbed``).
"""

from __future__ import annotations

from linkmart.plans.spec import Attr, Catalog, EntitySpec, FactSpec, Link

# ---- fixed values: the modelled warehouse's entities, columns and facts ----------------

_GAMES = Link("appearances", "games", "appearances_games", "game_url", "game_id")

WAREHOUSE = Catalog(
    entities=(
        EntitySpec(
            "staff", "staff",
            links=(Link("worked_on", "games", "worked_on_games", "game_url", "game_id"),),
        ),
        EntitySpec(
            "games", "game",
            attrs=(
                Attr("description", staged="description", dim="description"),
                Attr("developer", staged="developer", dim="developer"),
                Attr("publisher", staged="publisher", dim="publisher"),
                Attr("released_date", kind="date", staged="released_date", dim="released_date"),
            ),
        ),
        EntitySpec(
            "characters", "character",
            attrs=(
                Attr("description", staged="description", dim="description"),
                Attr("gender", staged="gender", dim="gender"),
                Attr("race", staged="race", dim="race"),
            ),
            links=(_GAMES,),
        ),
        EntitySpec(
            "monsters", "monster",
            attrs=(Attr("description", staged="description", dim="monster_description",
                        snapshot_kind="json"),),
            links=(Link("appearances", "games", "appearances_monster", "game_url", "game_id"),),
        ),
        EntitySpec(
            "dungeons", "dungeon",
            attrs=(Attr("description", staged="description", dim="dungeon_description",
                        snapshot_kind="json"),),
            links=(Link("appearances", "games", "appearances_dungeon", "game_url", "game_id"),),
        ),
        EntitySpec(
            "bosses", "boss",
            attrs=(Attr("description", staged="description", dim="boss_description"),),
            links=(
                _GAMES,
                Link("dungeons", "dungeons", "dungeons", "dungeon_url", "dungeon_id",
                     dead_letter=False),
            ),
        ),
        EntitySpec(
            "places", "place",
            attrs=(Attr("description", staged="description", dim="place_description"),),
            links=(
                _GAMES,
                Link("inhabitants", "characters", "inhabitants", "inhabitant_url",
                     "inhabitant_id", dead_letter=False),
            ),
        ),
        EntitySpec(
            "items", "item",
            attrs=(Attr("description", staged="description", dim="item_description"),),
            links=(Link("games", "games", "games", "game_url", "game_id"),),
        ),
    ),
    facts=(
        FactSpec("fct_staff_games", "staff", "worked_on", "all", (), ("released_date",)),
        FactSpec("fct_character_appearances", "characters", "appearances", "all", (),
                 ("released_date",)),
        FactSpec("fct_monster_appearances", "monsters", "appearances", "all",
                 ("monster_description",), ("released_date",)),
        FactSpec("fct_dungeon_appearances", "dungeons", "appearances", "all",
                 ("dungeon_description",), ("released_date",)),
        FactSpec("fct_item_appearances", "items", "games", "all", (), ("released_date",)),
        FactSpec("fct_boss_appearances", "bosses", "appearances", "current"),
        FactSpec("fct_boss_dungeons", "bosses", "dungeons", "current"),
        FactSpec("fct_place_appearances", "places", "appearances", "current"),
        FactSpec("fct_place_inhabitants", "places", "inhabitants", "current"),
    ),
)

# ---- testbed: the driver's tables in the same roles -------------------------------------
# orders    = entity with a link array (customers) and a long-form date text
# customers = conformed target dimension
# parts, suppliers = second dimension pair, linked row-wise by lineitem
# users     = change log from events (SCD2 / upsert replay)

TESTBED = Catalog(
    entities=(
        EntitySpec(
            "orders", "order",
            attrs=(
                Attr("status", staged="status", dim="order_status"),
                Attr("priority", staged="priority", dim="order_priority"),
                Attr("order_date", kind="date", staged="order_date", dim="order_date"),
            ),
            links=(Link("customers", "customers", "customers", "customer_url", "customer_id"),),
        ),
        EntitySpec(
            "customers", "customer",
            attrs=(Attr("segment", staged="segment", dim="segment"),),
        ),
        EntitySpec("parts", "part", attrs=(Attr("brand", staged="brand", dim="brand"),)),
        EntitySpec("suppliers", "supplier"),
        EntitySpec(
            "users", "user",
            attrs=(
                Attr("event_type", staged="event_type", dim="event_type"),
                Attr("props", kind="json", staged="props", snapshot_kind="json"),
            ),
        ),
    ),
    facts=(
        FactSpec("fct_order_customers", "orders", "customers", "current",
                 ("order_date",), ("segment",)),
        FactSpec("fct_order_customers_all", "orders", "customers", "all",
                 ("order_date",), ("segment",)),
    ),
)
