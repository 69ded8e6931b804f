"""Writers: raw landing, flat staging, warehouse loads and table DDL."""
