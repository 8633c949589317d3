"""Reading feeds, sheet grids and masters; writing months, parts and exception lists."""
