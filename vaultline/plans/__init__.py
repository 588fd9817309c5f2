"""Job plans (bronze -> silver -> gold), the query registry and its oracle."""
