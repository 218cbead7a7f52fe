"""The registered queries and the SQL that checks them."""
