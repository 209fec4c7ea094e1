"""Rule packs for the patients / appointments model, the star schema and the whole run."""
