"""Query plans over the star-schema tables: views and registered queries."""
